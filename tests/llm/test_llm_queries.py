"""Each operator against plain Python or the library itself, on small tables and on awkward rows."""

import base64
import hashlib
import zlib
from collections import defaultdict

import brute
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from narrata.llm import archive, decontaminate, html_text, language, minhash, pieces, quality, repeats, token_files, urls
from narrata.llm.common import table

SF = "/root/testdata/sf0.001"
BYTE_BPE, PIECE_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "\n\t ", "a", "A  b\r\n c", "é", "漢字 🙂 ok", "x\x00y", "one two three", "One TWO three", "▁ a ▁▁b", "it's <|endoftext|> we'll", " lead and trail ", "w " * 3000, "1 2 3 4 5 6 7 8 9 10 11 12"]


@pytest.fixture(scope="module")
def odd(spark):
    """Awkward texts, repeated rows, and columns whose names clash with results."""
    rows = [(i, t, "en", float(i), True, "z") for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, (None, "no id at all here", None, 0.0, False, "z"), rows[5], rows[5]], "doc_id long, text string, lang string, score double, kept boolean, component string")


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def run(spark, name):
    return entry.queries()[name](spark, SF)


def empty(df):
    return df.limit(0)


def test_token_files(spark, docs, odd, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE_BPE)

    def want(pairs):
        start, out = 0, []
        for d, t in sorted(pairs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
            ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
            out.append((d, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
            start += len(ids)
        return out

    got = run(spark, "op1_token_files").select("doc_id", "start", "n_tokens", "ids_crc32")
    assert rows(got) == sorted(want(docs), key=repr)
    path = f"{tmp_path}/odd"
    token_files.write(odd, path, BYTE_BPE)
    pairs = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(r.n_tokens for r in token_files.index(spark, path).collect()) == sorted(w[2] for w in want(pairs))
    back = {r.doc_id: bytes(r.tokens) for r in token_files.read(spark, path).collect()}
    assert all(library.decode(list(memoryview(back[i]).cast("I"))[:-1], skip_special_tokens=False) == (t or "") for i, t in enumerate(ODD))
    token_files.write(empty(odd), f"{tmp_path}/none", BYTE_BPE)
    assert token_files.index(spark, f"{tmp_path}/none").count() == 0


def test_token_frames_detect_damage():
    from narrata.llm.token_codec import decode_frame, encode_frame

    raw = b"".join((i * i % 5000).to_bytes(4, "little") for i in range(3000))
    frame = encode_frame([7, None], [raw, b""])
    ids, counts, out = decode_frame(frame)
    assert ids == [7, None] and counts.tolist() == [3000, 0] and out.tobytes() == raw
    with pytest.raises(ValueError):
        decode_frame(frame[:-400] + bytes(400))
    with pytest.raises(ValueError):
        decode_frame(b"none" + frame[4:])


def test_web_archive(spark, tmp_path):
    pages = [(r.page_id, r.html) for r in table(spark, SF, "pages").collect()]

    def want(pairs):
        first = {}
        for i, h in pairs:
            first[h or ""] = min(first.get(h or "", i), i)
        digest = lambda h: base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        return sorted(((i, len((h or "").encode()), digest(h or ""), "response" if first[h or ""] == i else "revisit", None if first[h or ""] == i else first[h or ""]) for i, h in pairs), key=repr)

    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert rows(run(spark, "op2_web_archive").select(*columns)) == want(pages)
    some = [(1, "u1", "<p>é</p>"), (2, None, None), (3, "u\r\nX: 1", ""), (4, "u4", "<p>é</p>"), (0, "u0", "")]
    df = spark.createDataFrame([(*r, "x", "y") for r in some], "page_id long, url string, html string, payload string, address string")
    path = f"{tmp_path}/archive"
    archive.write(df, path)
    assert rows(archive.listing(spark, path).select(*columns)) == want([(r[0], r[2]) for r in some])
    records = {r.record_id: bytes(r.warc) for r in archive.records(spark, path).collect()}
    assert records[1].endswith("\r\n\r\n<p>é</p>\r\n\r\n".encode()) and b"WARC-Type: revisit" in records[4] and b"<p>" not in records[4]
    head, rest = records[1].split(b"\r\n\r\n", 1)
    assert f"Content-Length: {len(rest) - 4}".encode() in head
    archive.write(empty(df), f"{tmp_path}/none")
    assert archive.listing(spark, f"{tmp_path}/none").count() == 0


def test_web_archive_of_odd_urls(spark, tmp_path):
    odd = ["u\u2028WARC-Refers-To: <urn:page:77>", "u\u0085WARC-Type: revisit", "", None, "a\r\nWARC-Type: revisit\r\n\r\nx", "\t", "a%20b", "x" * 5000]
    df = spark.createDataFrame([(i, u, f"page {i}") for i, u in enumerate(odd)] + [(90, odd[0], "page 0"), (None, "n", "page 1"), (91, "m", "p" * 200_000)], "page_id long, url string, html string")
    archive.write(df, f"{tmp_path}/a")
    got = {r.page_id: r for r in archive.listing(spark, f"{tmp_path}/a").collect()}
    for i, u in enumerate(odd):
        assert (got[i].url, got[i].record_type, got[i].refers_to) == (u and u.replace("\r", "%0D").replace("\n", "%0A"), "response", None)
    assert (got[90].record_type, got[90].refers_to, got[90].url) == ("revisit", 0, odd[0]) and (got[None].record_type, got[None].refers_to) == ("revisit", 1)
    assert got[91].payload_bytes == 200_000


def test_archive_refuses_wrong_payload(spark, tmp_path):
    spark.createDataFrame([("00", bytearray(b"x"))], "address string, payload binary").write.parquet(f"{tmp_path}/bad/payloads")
    with pytest.raises(Exception, match="does not fit"):
        archive.payloads(spark, f"{tmp_path}/bad").collect()


def test_main_text(spark):
    import html
    import re

    def article(source):
        body = re.search(r"<article>(.*?)</article>", source, re.S).group(1)
        return " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<(/?)(p|h1|br)\b[^>]*>", " ", body))).split())

    pages = {r.page_id: r for r in table(spark, SF, "pages").collect()}
    got = run(spark, "op3_html_text").collect()
    assert len(got) == len(pages)
    assert all(r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) for r in got)
    df = spark.createDataFrame([(1, None, None, "x"), (2, "u", "", "x"), (None, "u", "plain", "x"), (4, "u", "<p" * 50 + "<div>" * 3000, "x")], "page_id long, url string, html string, text string")
    assert {r.page_id: r.text for r in html_text.texts(df).collect()}[2] == ""
    assert html_text.texts(empty(df)).count() == 0


def test_pages_with_odd_tags():
    import time

    from narrata.llm.dom import Page

    def text(source):
        page = Page(source, given=True)
        return [page.texts[i] for i in page.order]

    assert text("<p>He <a href=x title=it's>said</a> that it's fine, really.</p>") == ["He said that it's fine, really."]
    assert text('<script src="a.js" />var x = 1;</script><p>Text</p>') == ["Text"]
    assert text("<script>if (a</scripty>b) x()</SCRIPT >\n<p>T</p>") == ["T"]
    assert text('<p title="a > b" class=x>T</p><svg/><p>U</p>') == ["T", "U"]
    assert text('<p title="unclosed>T</p>') == ["T"] and text("a < b <3 c") == ["a < b <3 c"]
    assert text("<p>one<p>two</section></p><div>three") == ["one", "two", "three"]
    for awkward in ("<a " * 350_000, '<a b="' * 150_000, "<a x='>' " * 100_000, "<!" * 500_000, "<div>" * 50_000 + "</p2>" * 50_000, "</" * 300_000, "<script>" * 100_000, "&" * 500_000):
        start = time.time()
        Page(awkward, given=True)
        assert time.time() - start < 10


def test_main_text_of_pages_with_label_attributes(spark):
    from narrata.llm.dom import Page

    # the values of grids, charts and parallax effects are no labels, whatever they look like
    values = ['"10.5"', '"50%"', '""', "0", "'1'", '"7"']
    page = "<body{0}><nav{0}><a href='/'>Home</a></nav><article{0}><p{0}>{1}</p><div{0}><p>{1}</p></div></article><footer{0}>Legal</footer></body>"
    prose = "A sentence of some length, with a comma. Another one follows it, and then it ends."
    df = spark.createDataFrame([(i, page.format(f" data-y={v}" if v else "", prose)) for i, v in enumerate([None, *values])], "page_id long, html string").withColumn("url", F.lit("u"))
    got = {r.page_id: r.text for r in html_text.texts(df).collect()}
    assert len(got) == 1 + len(values) and set(got.values()) == {f"{prose} {prose}"}
    assert set(Page(page.format(' data-y="1"', prose), given=True).label) == {None}


def test_main_text_of_random_layouts():
    from narrata.llm.dom import Page
    from narrata.llm.page_grammar import Grammar

    model, odds = html_text.fit([])
    grammar, right, total = Grammar(77), 0, 0
    for _ in range(150):
        page = Page(grammar.page())
        page.sums()
        want = [i for i in page.order if page.truth()[i] == 1]
        got = html_text.decode(page, model.scores(page.features(odds)))
        right += len(set(want) & set(got)) - len(set(got) - set(want))
        total += len(want)
    assert right >= 0.97 * total


def quality_counts(text):
    import re

    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = defaultdict(list)
    for k in range(len(words) - 2):
        windows[tuple(words[k:k + 3])].append(k)
    covered = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def test_quality(spark, docs, odd):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = run(spark, "op4_quality")
    assert rows(got.select(*columns)) == sorted(((d, *quality_counts(t)) for d, t in docs), key=repr)
    assert got.filter("kept and base_failed").count() == 0
    judged = got.join(table(spark, SF, "labels").withColumnRenamed("quality", "good"), "doc_id").filter("not base_failed")
    share = judged.groupBy("good").agg(F.avg(F.col("kept").cast("int")).alias("s"))
    shares = {r.good: r.s for r in share.collect()}
    assert shares[1] > 0.97 and shares.get(0, 0) < 0.2
    pairs = [(r.doc_id, r.text) for r in odd.collect()]
    assert rows(quality.judge(odd).select(*columns)) == sorted(((d, *quality_counts(t)) for d, t in pairs), key=repr)
    assert quality.judge(empty(odd)).count() == 0


def test_expectation_maximisation_finds_accuracies(spark):
    import random

    rnd, data = random.Random(5), []
    for _ in range(4000):
        good = rnd.random() < 0.7
        vote = lambda right, speak: 0 if rnd.random() > speak else (1 if good == (rnd.random() < right) else -1)  # noqa: B023, E731
        data.append((vote(0.95, 1.0), vote(0.8, 0.7), vote(0.9, 0.5), vote(0.7, 1.0)))
    prior, good, bad = quality.fit(spark.createDataFrame(data, "a int, b int, c int, d int"), ["a", "b", "c", "d"])
    assert abs(prior - 0.7) < 0.05
    for k, right in enumerate((0.95, 0.8, 0.9, 0.7)):
        assert abs(good[k] - right) < 0.06 and abs(bad[k] - right) < 0.1


def test_pieces(spark, docs, odd):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)

    def want(pairs):
        coded = [(d, library.encode(t or "")) for d, t in pairs]
        return sorted(((d, len(i), brute.sha(",".join(map(str, i))), brute.sha(library.decode(i))) for d, i in coded), key=repr)

    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert rows(run(spark, "op5_pieces").select(*columns)) == want(docs)
    assert rows(pieces.digests(odd, PIECE_BPE).select(*columns)) == want([(r.doc_id, r.text) for r in odd.collect()])
    for r in pieces.encode(odd, PIECE_BPE).filter("doc_id is not null").dropDuplicates(["doc_id"]).collect():
        raw = (ODD[r.doc_id] or "").encode()
        assert [b for b, e in zip(r.begins[1:], r.ends[:-1], strict=True) if b > e] == [] and (not r.ends or r.ends[-1] == len(raw))
        for i, b, e in zip(r.ids, r.begins, r.ends, strict=True):
            piece = library.id_to_piece(i)
            if not library.is_byte(i) and e > b:
                assert raw[b:e].decode().replace(" ", "▁") in (piece, piece[1:])
    assert pieces.tokens(odd, PIECE_BPE).filter("not exact and text is null" if "text" in pieces.tokens(odd, PIECE_BPE).columns else "doc_id = 10 and not exact").count() == 0
    assert pieces.digests(empty(odd), PIECE_BPE).count() == 0


def test_character_map_takes_the_longest_prefix():
    import struct

    from narrata.llm.piece_bpe import CharacterMap

    # a double array for a -> "x", ab -> "yz": a node's children lie at node ^ byte, leaves with the value at node ^ 0
    strings, units = b"x\0yz\0", [0] * 1024

    def place(node, byte, child_offset, leaf):
        units[node] = (child_offset << 10) | (256 if leaf else 0) | byte

    units[0] = 256 << 10
    a = 256 ^ ord("a")
    place(a, ord("a"), a ^ 512, True)
    units[512] = 0x80000000 | 0
    b = 512 ^ ord("b")
    place(b, ord("b"), b ^ 768, True)
    units[768] = 0x80000000 | 2
    compiled = struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + strings
    found = CharacterMap(compiled)
    assert found.longest(b"abc", 0) == (2, b"yz") and found.longest(b"ac", 0) == (1, b"x") and found.longest(b"ba", 0) is None


def test_repeats(spark, docs, odd):
    import random

    assert rows(run(spark, "op6_repeats")) == sorted(brute.repeated_bytes(docs), key=repr)
    rnd = random.Random(3)
    base = ["".join(rnd.choice("ab é") for _ in range(rnd.choice((0, 50, 99, 100, 101, 150, 400)))) for _ in range(12)] + ["a" * 350, "ab" * 200, "x" * 120]
    made = [(i, "".join(rnd.choice(base)[rnd.randrange(30):] for _ in range(rnd.randrange(1, 4)))) for i in range(120)] + [(1000, None), (1001, ""), (1002, "a" * 5000)]
    df = spark.createDataFrame(made, "doc_id long, text string").repartition(5)
    want = brute.repeated_bytes(made)
    assert rows(repeats.digests(df)) == sorted(want, key=repr)
    cut = {r.doc_id: r.text for r in repeats.remove(df).collect()}
    assert cut[1000] is None and all("\ufffd" not in (t or "") for t in cut.values())
    assert {r.doc_id for r in repeats.digests(odd).collect()} == {r.doc_id for r in odd.collect()}
    same = spark.createDataFrame([(1, "q" * 50 + "r" * 90), (1, "q" * 50 + "r" * 90)], "doc_id long, text string")
    assert [r.n_removed for r in repeats.digests(same).collect()] == [0, 0]
    assert repeats.digests(empty(odd)).count() == 0


def test_repeats_of_different_texts_with_one_id(spark):
    import random

    def want(rows_):
        before, out = set(), []
        for d in sorted({d for d, _ in rows_}):
            seen = set()  # rows of one id are not earlier than each other
            for t in (t for i, t in rows_ if i == d):
                own, gone = set(), bytearray(len(t))
                for k in range(len(t) - 99):
                    if t[k:k + 100] in before or t[k:k + 100] in own:
                        gone[k:k + 100] = b"\1" * 100
                    own.add(t[k:k + 100])
                seen |= own
                kept = "".join(c for c, g in zip(t, gone, strict=True) if not g)
                out.append((d, len(t), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept.encode()).hexdigest()))
            before |= seen
        return sorted(out, key=repr)

    rnd = random.Random(6)
    word = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    old, one, other = word(150), word(400), word(130)
    few = [(1, old), (2, one[:200] + old + one[200:]), (2, one), (2, other + one[150:330] + other), (3, other[:110] + one[:120])]
    assert rows(repeats.digests(spark.createDataFrame(few, "doc_id long, text string"))) == want(few)
    assert (2, one) in {(r.doc_id, r.text) for r in repeats.remove(spark.createDataFrame(few, "doc_id long, text string")).collect()}
    base = [word(rnd.choice((101, 150, 300))) for _ in range(14)] + ["a" * 300]
    many = [(rnd.randrange(40), "".join(rnd.choice(base)[rnd.randrange(30):] for _ in range(rnd.randrange(1, 5)))) for _ in range(160)]
    assert rows(repeats.digests(spark.createDataFrame(many, "doc_id long, text string").repartition(5))) == want(many)


def test_repeats_of_a_core_in_many_shards(spark):
    import random

    rnd = random.Random(4)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(130))
    made = [(i, "".join(rnd.choice("ijklmnop ") for _ in range(rnd.randrange(60))) + passage[rnd.randrange(25):130 - rnd.randrange(5)] + "".join(rnd.choice("qrstu ") for _ in range(60))) for i in range(600)]
    rows_ = sorted(((7, i, 0, t.encode()[:120]) for i, t in made))
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*[(c, d, (a << 7) | 21, b) for c, d, a, b in rows_], strict=True)], ["core", "doc_id", "at", "data"])
    whole = list(repeats.classes(iter([batch])))
    kept, repeats.SHARD = repeats.SHARD, 50
    try:
        parts = list(repeats.classes(iter([batch.slice(0, 333), batch.slice(333)])))
    finally:
        repeats.SHARD = kept
    # what the shards leave open are firsts, and every window is either a repeat in its shard or the first of a class there
    late = sum(b.column("core").null_count for b in whole)
    early = sum(b.column("core").null_count for b in parts)
    firsts = [(c, h, d, a) for b in parts for c, h, d, a in zip(*(b.column(n).to_pylist() for n in ("core", "hull", "doc_id", "at")), strict=True) if c is not None]
    assert early + len(firsts) == 600 * 21 and early + len(firsts) - len({f[:2] for f in firsts}) == late


def test_repeats_of_one_very_long_text(spark):
    import random

    rnd = random.Random(8)
    part = "".join(rnd.choice("abcdefgh ") for _ in range(9000))
    made = [(1, part + "#" + part[2000:6000] + "!" + part[:500]), (2, part[4000:9000])]
    assert rows(repeats.digests(spark.createDataFrame(made, "doc_id long, text string"))) == sorted(brute.repeated_bytes(made), key=repr)


def test_language(spark, odd):
    got = run(spark, "op7_language")
    labelled = got.join(table(spark, SF, "documents").select("doc_id", "lang", "text"), "doc_id").filter("held_out and length(text) > 100")
    assert labelled.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
    assert {r.doc_id: r.held_out for r in got.collect()} == {d: brute.held_out(d) for d in range(got.count())}
    languages, model = language.fit(table(spark, SF, "documents"))
    found = {r.doc_id: r for r in language.identify(odd.select("doc_id", "text", F.lit(1).alias("lang_pred")), languages, model).collect()}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (0, 1, 2, 3, 15)) and found[14].lang_pred in languages
    assert language.fit(empty(odd)) == ([], None)
    assert {r.lang_pred for r in language.identify(odd, [], None).collect()} == {"und"}
    assert language.accepted(odd, languages, model).columns == odd.columns


def test_language_sample(spark, monkeypatch):
    """The slots kept before the window hold the first rows by hash of every language, and few others."""
    monkeypatch.setattr(language, "SAMPLE_DOCS", 50)
    rows = spark.range(0, 20000, 1, 16).select(F.when(F.col("id") % 3 == 0, "aa").when(F.col("id") % 1000 == 1, "bb").otherwise("cc").alias("lang"), F.xxhash64(F.col("id"), F.lit("sample")).alias("h"))
    rows = rows.unionByName(rows.filter("lang = 'bb'"))
    kept = {}
    for r in language.below_cut(rows, rows).collect():
        kept.setdefault(r.lang, []).append(r.h)
    every = {}
    for r in rows.collect():
        every.setdefault(r.lang, []).append(r.h)
    assert {k: sorted(v)[:50] for k, v in kept.items()} == {k: sorted(v)[:50] for k, v in every.items()}
    assert all(len(v) < 60 for v in kept.values()) and len(kept) == 3


def test_language_gradients():
    import numpy as np

    from narrata.llm import bigru

    rng = np.random.default_rng(0)
    model = bigru.initial(3, 1)
    x, y, mask = rng.integers(0, 256, (7, 4)), np.array([0, 1, 2, 1]), np.ones((7, 4), np.float32)
    mask[5:, 1] = 0

    def loss():
        p = bigru.position_probs(model, x)
        return float(-(np.log(p[:, y, np.arange(4)]) * mask).sum() / mask.sum())

    grads = bigru._gradients(model, x, mask, y)
    for name, spot in (("rec_f", (3, 2)), ("rec_b", (18, 5)), ("out", (1, 9)), ("in_f", (20, int(x[2, 0]))), ("in_b", (9, int(x[3, 3]))), ("bias", (2, 0))):
        kept = model[name][spot]
        model[name][spot] = kept + 1e-2
        up = loss()
        model[name][spot] = kept - 1e-2
        down = loss()
        model[name][spot] = kept
        assert abs((up - down) / 2e-2 - grads[name][spot]) < 2e-3, name


def test_urls(spark):
    def parts(url):
        import re

        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        return (brute.lower(m.group(1)), m.group(2)) if m else ("", "")

    def rule(host, path):
        fit = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fit)[1:] if fit else (None, None)

    got = run(spark, "op8_url_filter").collect()
    pages = {r.page_id: r.url for r in table(spark, SF, "pages").collect()}
    assert len(got) == len(pages)
    for r in got:
        host, path = parts(pages[r.page_id])
        name, verdict = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name) and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    some = [(1, None), (2, "no scheme"), (3, "http://"), (4, "HTTP://WWW.Example.NET/en/x?y#z"), (5, "a://b.org/fr/"), (6, "a://x.net?/en/"), (7, "a://net"), (8, "a://b.org/fr/"), (None, "q://\u00e9.com/de/")]
    df = spark.createDataFrame([(*r, "x", "y") for r in some], "page_id long, url string, host string, key string")
    found = [(r.page_id, r.host, r.path, r.rule) for r in urls.judge(df).collect()]
    assert sorted(found, key=repr) == sorted(((i, *parts(u), rule(*parts(u))[0]) for i, u in some), key=repr)
    assert urls.judge(empty(df)).count() == 0
    assert {r.verdict for r in urls.judge(df.filter("page_id < 4")).collect()} == {"allow"}


def test_url_verdicts_read_the_whole_url(spark):
    words = ("casino", "poker", "slots", "bets")
    made = [(i, f"http://a{i % 5}.example.net/en/p?page={i}") for i in range(40)] + [(100 + i, f"http://a{i % 5}.net/p?{words[i % 4]}={i}") for i in range(40)]
    asked = {200: "http://b.de/p?page=7", 201: "HTTP://B.de/p?casino=7", 202: "http://B.DE/p?casino=7", 203: "http://b.de/p#poker=7", 204: "b.de/p?slots=9", 205: "b.de/p?page=9"}
    df = spark.createDataFrame([*made, *asked.items(), (206, None), (207, "")], "page_id long, url string")
    got = {r.page_id: r for r in urls.judge(df).collect()}
    assert len(got) == len(made) + len(asked) + 2
    assert {i: got[i].verdict for i in asked} == {200: "allow", 201: "block", 202: "block", 203: "block", 204: "block", 205: "allow"}
    assert (got[201].host, got[201].path) == (got[200].host, got[200].path) == ("b.de", "/p") and got[201].score != got[202].score
    assert all(got[i].verdict == "allow" and got[i].score == 0 for i in (206, 207))
    found = [r.w for r in df.filter("page_id in (201, 204, 206)").orderBy("page_id").select(urls.whole(F.col("url")).alias("w")).collect()]
    assert found == ["HTTP://b.de/p?casino=7", "b.de/p?slots=9", ""]


def test_url_model_equals_plain_python(spark):
    import math

    seen = {"a": {"abca": 2, "abd": 1}, "r": {"xbca": 1, "xx": 3}}
    n = urls.ORDER
    counts = {k: [defaultdict(int) for _ in range(n + 1)] for k in seen}
    grams = set()
    for k, words in seen.items():
        for w, times in words.items():
            padded = "\u0002" * n + w
            for i in range(len(w)):
                g = padded[i:i + n + 1]
                grams.add(g)
                for o in range(n + 1):
                    counts[k][o][g[n - o:]] += times

    def prob(k, g):
        p = 1 / 65536
        for o in range(n + 1):
            same = {x: c for x, c in counts[k][o].items() if x[:o] == g[n - o:n]}
            total = sum(same.values()) + len(same)
            p = (same.get(g[n - o:], 0) + len(same) * p) / total if total else p
        return p

    rows_ = [(g, counts["a"][n].get(g, 0), counts["r"][n].get(g, 0)) for g in grams]
    got = {r.g: r.ratio for r in urls.log_ratio(spark.createDataFrame(rows_, "g string, a long, r long")).collect()}
    assert set(got) == grams and all(abs(got[g] - math.log(prob("a", g) / prob("r", g))) < 1e-9 for g in grams)


def test_word_hashes_of_structured_words(spark):
    a = "ab"
    while len(a) < 1024:
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    made = [(1, a), (2, b), (3, a + " x y z"), (4, b + " x y z"), (5, "a" * 3000), (6, "a" * 3001), (7, "\x00"), (8, "\x00\x00")]
    df = spark.createDataFrame(made, "doc_id long, text string")
    assert rows(minhash.groups(df)) == sorted(brute.near_duplicates(made), key=repr)
    found = {r.doc_id: r.n_hit for r in decontaminate.screen(df, spark.createDataFrame([(1, a), (2, "a" * 3000)], "item_id long, text string")).collect()}
    assert found == {1: 1, 2: 0, 3: 1, 4: 0, 5: 1, 6: 0, 7: 0, 8: 0}


@pytest.mark.parametrize("block", [3, 16])
def test_large_groups_in_chunks_equal_brute_force(spark, monkeypatch, block):
    import random

    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "FEW", 2)
    rnd = random.Random(block)
    made, words = [], [f"w{i}" for i in range(40)]
    for start in range(3):  # drifting chains: what is far from the smallest member hangs on by others
        text = [rnd.choice(words) + str(start) for _ in range(60)]
        for _ in range(45):
            made.append(" ".join(text))
            text[rnd.randrange(60)] = rnd.choice(words)
    rnd.shuffle(made)
    pairs = list(enumerate(made))
    assert rows(minhash.groups(spark.createDataFrame(pairs, "doc_id long, text string"))) == sorted(brute.near_duplicates(pairs), key=repr)


def test_edges_of_one_large_group_are_few(spark):
    import random

    rnd = random.Random(7)
    text = [f"w{rnd.randrange(400)}" for _ in range(300)]
    made = []
    for i in range(3000):
        copy = list(text)
        copy[rnd.randrange(300)] = f"n{i}"
        made.append((i, " ".join(copy)))
    df = spark.createDataFrame(made, "doc_id long, text string")
    signed = minhash.signatures(df, 4, "doc_id", "text").select(F.col("doc_id").alias("rep"), "signature")
    members = signed.select(F.lit(0).cast("long").alias("grp"), "rep")
    edges = minhash.linked(members, signed.select("rep", "signature"), minhash.collide)
    assert 2999 <= edges.count() < 2 * 3000
    assert {r.component_id for r in minhash.groups(df).collect()} == {0}


def test_clashing_columns_survive_removal(spark):
    text = "the quick brown fox jumps over the lazy dog again and again until the evening comes and all is quiet in the yard " * 2
    names = "_gone _id _key _at key c0 c1 kept component rep grp root"
    df = spark.createDataFrame([(1, text, *range(12)), (2, text, *range(12)), (3, "x " + text, *range(12)), (None, None, *range(12))], "doc_id long, text string, " + ", ".join(f"{n} long" for n in names.split()))
    assert minhash.remove(df).columns == df.columns and {r.doc_id for r in minhash.remove(df).collect()} == {1, None}
    cut = repeats.remove(df)
    assert cut.schema == df.schema and {r.doc_id: len(r.text or "") for r in cut.collect()}[1] > 50
    assert all((r._id, r._key, r._at, r.c0, r.c1) == (1, 2, 3, 5, 6) for r in cut.collect())


def test_near_duplicates(spark, docs, odd):
    assert rows(run(spark, "op9_near_duplicates")) == sorted(brute.near_duplicates(docs), key=repr)
    import random

    rnd = random.Random(11)
    base = [rnd.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(rnd.randrange(60)) for _ in range(120)]
    made = []
    for i in range(400):
        words = list(base)
        for _ in range(rnd.choice((0, 1, 2, 3, 5, 8))):
            words[rnd.randrange(len(words))] = f"w{rnd.randrange(10**6)}"
        made.append((i, " ".join(words)))
    df = spark.createDataFrame(made, "doc_id long, text string")
    assert rows(minhash.groups(df)) == sorted(brute.near_duplicates(made), key=repr)
    got = {r.doc_id: r for r in minhash.groups(odd).collect()}
    assert got[None].component_id is None and got[None].kept and got[10].component_id == 9 and got[0].n_shingles == 0
    assert minhash.groups(empty(odd)).count() == 0
    kept = minhash.remove(df, size=4)
    assert kept.count() == sum(w[3] for w in brute.near_duplicates(made))


def test_near_duplicates_of_a_group_over_several_chunks(spark):
    import random

    rnd = random.Random(11)
    base = [rnd.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(rnd.randrange(60)) for _ in range(120)]
    made = []
    for i in range(900):
        words = list(base)
        for _ in range(rnd.choice((0, 1, 2, 3, 5, 8))):
            words[rnd.randrange(len(words))] = f"w{rnd.randrange(10**6)}"
        made.append((i, " ".join(words)))
    assert len({t for _, t in made}) > minhash.BLOCK  # more than one chunk of texts that differ
    df = spark.createDataFrame(made, "doc_id long, text string")
    assert rows(minhash.groups(df)) == sorted(brute.near_duplicates(made), key=repr)


def test_near_duplicate_filter_is_selective(spark):
    ids = spark.range(0, 1000, 10).withColumnRenamed("id", "node")
    passed = minhash.may_match(spark.range(0, 20000), "id", ids)
    assert passed.filter("id < 1000 and id % 10 = 0").count() == 100 and passed.count() < 300


def test_decontamination(spark, docs, odd):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert rows(run(spark, "op10_decontaminate")) == sorted(brute.decontaminate(docs, items), key=repr)
    small = [(1, "one two three"), (2, "w w w w w w w w w w w"), (3, None), (None, "a"), (4, "!!"), (5, "a"), (6, "4 5 6 7 8 9 10 11 12")]
    bench = spark.createDataFrame(small, "item_id long, text string")
    pairs = [(r.doc_id, r.text) for r in odd.collect()]
    got = decontaminate.screen(odd, bench)
    assert rows(got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long"))) == sorted((w[:4] for w in brute.decontaminate(pairs, small)), key=repr)
    assert decontaminate.remove(odd, bench).count() == sum(not w[5] for w in brute.decontaminate(pairs, small))
    assert decontaminate.screen(empty(odd), bench).count() == 0
    assert decontaminate.screen(odd, empty(bench)).filter("n_hit > 0").count() == 0
    found = decontaminate.matches(spark.createDataFrame([(1, "x " + " ".join(map(str, range(30))) + " y")], "doc_id long, text string"), spark.createDataFrame([(9, "q " + " ".join(map(str, range(5, 25))) + " z")], "item_id long, text string"))
    assert rows(found) == [(1, 9, 6, 1, 20)]


def test_decontamination_in_blocks(spark, monkeypatch):
    items = [(i, " ".join(f"b{i}x{k}" for k in range(12))) for i in range(40)]
    pairs = [(d, " ".join(t for _, t in items[d:d + 3]) + " tail") for d in range(30)]
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.screen(spark.createDataFrame(pairs, "doc_id long, text string"), bench)
    assert rows(got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long"))) == sorted((w[:4] for w in brute.decontaminate(pairs, items)), key=repr)
