"""The Merkle manifest, personal data and periodic runs against plain Python, on small tables and on awkward rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from narrata.llm import merkle, periodic, personal
from narrata.llm.common import table

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\t ", "a", "A  b\r\n c", "é", "漢字 🙂 ok a@b.co", "x\x00y", "w " * 3000, "1 2 3 4 5 6 7 8 9 10 11 12", "ab ba " * 20, "call +1 (555) 123-4567 or 4111 1111 1111 1111, 10.0.0.1"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents").collect()


@pytest.fixture(scope="module")
def odd(spark):
    """Awkward texts, repeated rows, null ids and trees, and columns whose names clash with results."""
    made = [(i, t, ["en", None, "ß", ""][i % 4], "s", len(t or "") if i % 3 else None, "z", 1, "q", 0, "p", "o") for i, t in enumerate(ODD)]
    made += [(None, "no id", None, None, 5, "z", 1, "q", 0, "p", "o"), (None, "no id", None, None, 5, "z", 1, "q", 0, "p", "o"), made[5], made[5]]
    return spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long, tree string, rank int, node string, block int, steps string, place string")


# --- manifest -------------------------------------------------------------------------------------------------


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, more=0):
    return sha("".join(map(encoded, (r.doc_id, r.source, r.lang, None if r.n_chars is None else r.n_chars + more, r.text))))


def tree(level):
    """(root, siblings of each leaf with their side)."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for path, i in zip(paths, at, strict=True):
            if i ^ 1 < len(level):
                path.append(("L" if i & 1 else "R") + level[i ^ 1])
            else:
                path.append("")
        level, at = [sha("".join(level[i:i + 2])) for i in range(0, len(level), 2)], [i // 2 for i in at]
    return level[0], paths


def manifest(docs):
    by = {}
    for r in docs:
        by.setdefault(b"" if r.lang is None else b"=" + r.lang.encode(), []).append(r)
    for group in by.values():
        group.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
    subs = {k: tree([leaf(r) for r in by[k]]) for k in sorted(by)}
    root, high = tree([s[0] for s in subs.values()])
    out = []
    for (k, (sub, paths)), last in zip(subs.items(), high, strict=True):
        for r, path in zip(by[k], paths, strict=True):
            steps = path + last
            at = leaf(r, r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0)
            for s in steps:
                at = sha(s[1:] + at if s[:1] == "L" else at + s[1:])
            out.append((r.doc_id, leaf(r), sub, root, sha("".join(s[1:] for s in steps)), at, at == root))
    return sorted(out, key=repr)


def checked(found):
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("steps")).alias("p"), merkle.folded(F.col("other"), F.col("steps")).alias("f")).withColumn("ok", F.col("f") == F.col("root"))


def test_manifest(spark, docs):
    got = entry.queries()["op11_manifest"](spark, SF)
    assert rows(got) == manifest(docs)
    assert {r.verified for r in got.collect()} == {True, False}


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_manifest_of_awkward_rows_in_blocks_of_any_size(spark, odd, bits):
    drawn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = {"n_chars": F.when(drawn, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    assert rows(checked(merkle.manifest(odd, changed=changed, bits=bits))) == manifest(odd.collect())


def test_manifest_of_many_blocks(spark, docs):
    found = merkle.manifest(table(spark, SF, "documents"), bits=3)
    want = [(*w[:5], w[3], True) for w in manifest(docs)]
    assert rows(checked(found)) == sorted(want, key=repr)


def test_manifest_of_many_trees_few_rows_and_none(spark):
    many = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.concat(F.lit("l"), "id").alias("lang"), F.lit(3).cast("long").alias("n_chars"), F.lit("abc").alias("text"))
    assert rows(checked(merkle.manifest(many, bits=2))) == sorted([(*w[:5], w[3], True) for w in manifest(many.collect())], key=repr)
    one = merkle.manifest(many.limit(1)).collect()
    assert one[0].leaf == one[0].root == one[0].subroot and one[0].steps == []
    assert merkle.manifest(many.limit(0)).count() == 0


def test_frontier_extends_witnesses():
    rnd = random.Random(4)
    for n in [*range(1, 40), 100, 255, 256, 257]:
        nodes = [sha(str(rnd.random())) for _ in range(n)]
        frontier = merkle.Frontier()
        for node in nodes:
            frontier.append(node)
            assert [s[0] for s in frontier.open] == sorted({s[0] for s in frontier.open}, reverse=True)
        assert (frontier.close(None), frontier.witness) == tree(nodes)


# --- personal data --------------------------------------------------------------------------------------------

EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base(t):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(t):
        digits = re.sub(r"[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 9 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def said(spans):
    return ",".join(f"{personal.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def counts(t):
    found = base(t or "")
    return (*[sum(k == i for _, k, _ in found) for i in range(4)], sha(said(found)))


def test_personal_data(spark, docs):
    got = {r.doc_id: r for r in entry.queries()["op12_personal_data"](spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        r = got[d.doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == counts(d.text)
        spans = r.spans.split(",") if r.spans else []
        assert set(said(base(d.text or "")).split(",")) - {""} <= set(spans)
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), personal.KINDS.index(s.split(":")[0])))


def test_base_patterns_equal_the_plain_ones():
    rnd = random.Random(8)
    for _ in range(20_000):
        letters = rnd.choice(["a.@-b1", "01.2 +-()5", "0123456789 -", "1@a.+ ", "é1.5"])
        t = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60)))
        assert personal.base(t) == base(t)


def test_long_awkward_texts_take_linear_time():
    model = personal.fit([])
    for t in ("1" * 200_000, "a" * 200_000 + "@", "@a.b " * 4000, "1." * 50_000, "+1((((" * 20_000, "a at b.c " * 2000, "1 2 " * 10_000, "é" * 100_000):
        fixed, found = personal.spans(t, model)
        assert set(fixed) <= set(found)


def test_candidates_are_judged_by_form_and_context(docs):
    model, grammar = personal.fit([d.text for d in docs[:150] if d.text]), personal.Grammar(77)
    right = wrong = missed = 0
    for d in docs[150:]:
        text, planted = grammar.set_into(d.text or "word")
        fixed, found = personal.spans(text, model)
        planted = {p for p in planted if not any(s < p[2] and p[0] < e for s, _, e in fixed)}
        more = set(found) - set(fixed)
        right, wrong, missed = right + len(more & planted), wrong + len(more - planted), missed + len(planted - more)
    assert right >= 0.95 * (right + wrong) and right >= 0.9 * (right + missed)
    for text in ("Section 4.2 of 2024-05-06 has 1234567890123456 rows.", "Meet at home. Then go on.", "See v1.2.3 at 10:30:15."):
        assert personal.spans(text, model) == ([], [])


def test_personal_data_of_awkward_rows(spark, odd):
    found = personal.find(odd).collect()
    assert len(found) == odd.count()
    by = {r.doc_id: r for r in found}
    for i, t in enumerate(ODD):
        assert [(s.start, personal.KINDS.index(s.kind), s.end) for s in by[i].base] == base(t or "")
    assert by[12].redacted == "call [PHONE] or [CARD], [IP]" and by[0].redacted == "" and by[7].redacted.endswith("ok [EMAIL]")
    assert personal.find(odd.limit(0)).count() == 0


# --- periodic runs --------------------------------------------------------------------------------------------


def plain_runs(w, least=12):
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q) and j > i:
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def words_of(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def summary(doc_id, w):
    found = plain_runs(w)
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None, sha(lines), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_periodic_runs(spark, docs, odd):
    got = rows(entry.queries()["op13_periodic_runs"](spark, SF))
    assert got == sorted((summary(d.doc_id, words_of(d.doc_id, d.text)) for d in docs), key=repr)
    plain = rows(periodic.digests(periodic.runs(odd)))
    assert plain == sorted((summary(r.doc_id, re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in odd.collect()), key=repr)
    made = odd.select("doc_id", periodic.planted(F.col("doc_id"), F.col("text")).alias("text")).collect()
    for r, o in zip(made, odd.collect(), strict=True):
        assert re.findall(r"[^\x20\x09-\x0D]+", r.text or "") == words_of(o.doc_id, o.text)
    assert periodic.runs(odd.limit(0)).count() == 0


def test_runs_of_random_and_highly_periodic_words():
    rnd = random.Random(2)
    for _ in range(3000):
        texts = []
        for _ in range(rnd.randint(1, 5)):
            n, shape = rnd.randint(0, 70), rnd.random()
            w = [rnd.randrange(rnd.choice([1, 2, 2, 3])) for _ in range(n)]
            if shape < 0.4 and n:
                p = rnd.randint(1, max(1, n // 3))
                w = [w[i % p] for i in range(n)]
                for _ in range(rnd.randint(0, 3)):
                    w[rnd.randrange(n)] = rnd.randrange(2)
            elif shape < 0.6:
                w = ([0] * rnd.randint(1, 9) + [1]) * rnd.randint(1, 9) + [0] * rnd.randint(0, 9) + w[:20]
            texts.append(w)
        least = rnd.choice([1, 2, 12])
        owner, start, length, period = periodic.find(np.array([x for t in texts for x in t], np.int64), np.array([len(t) for t in texts]), least)
        got = [[] for _ in texts]
        for o, *run in zip(owner.tolist(), start.tolist(), length.tolist(), period.tolist(), strict=True):
            got[o].append(tuple(run))
        assert got == [plain_runs(t, least) for t in texts]


def test_runs_of_a_long_text():
    w = np.array(([0] * 400 + [1]) * 50)
    owner, start, length, period = periodic.find(w, np.array([len(w)]))
    assert (0, len(w), 401) in set(zip(start.tolist(), length.tolist(), period.tolist(), strict=True)) and len(owner) == 51
