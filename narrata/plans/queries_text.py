"""Queries on sources, text functions and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from narrata.functions import dates as D
from narrata.functions import text as T
from narrata.operators import profiling as P
from narrata.operators import temporal
from narrata.operators.errors import as_percent, pick_rows
from narrata.operators.ranking import first_per_key
from narrata.plans import sql as S
from narrata.plans.registry import query, table
from narrata.sources import pages as PG
from narrata.sources import tables as TB
from narrata.sources.taxonomy import CONFIG, load_taxonomy, read_entries, taxonomy_entries


def _as_export(spark, sf_dir):
    """Documents under the column names of a complaint export, with gaps and blanks derived from the data."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    d = d.join(lab, "doc_id", "left")
    return d.select(
        F.col("doc_id").alias("Complaint ID"),
        F.when(F.col("toxic") == 1, None).otherwise(F.col("source")).alias("Product"),
        F.when(F.col("quality") == 0, "  \n ").otherwise(F.col("text")).alias("Consumer Complaint"),
        F.when(F.col("quality").isNotNull(), F.col("lang")).alias("Issue"))


_EXPORT = """export AS (SELECT doc_id AS id, CASE WHEN toxic = 1 THEN NULL ELSE source END AS product,
 CASE WHEN quality = 0 THEN '  ' || chr(10) || ' ' ELSE text END AS txt, CASE WHEN quality IS NOT NULL THEN lang END AS issue
 FROM documents LEFT JOIN labels USING (doc_id))"""
_BLANK = f"(txt IS NULL OR trim({S.blanks('txt')}, ' ' || chr(9) || chr(10) || chr(13) || chr(12)) = '')"


@query("standardized_records", f"""WITH {_EXPORT} SELECT id AS complaint_id, product AS category, txt AS text, issue AS "Issue" FROM export""")
def standardized_records(spark, sf_dir):
    return TB.standardize(_as_export(spark, sf_dir)).select("complaint_id", "category", "text", "Issue")


@query("valid_records", f"WITH {_EXPORT} SELECT id AS complaint_id, product AS category, length(txt) AS chars FROM export WHERE NOT {_BLANK} AND product IS NOT NULL")
def valid_records(spark, sf_dir):
    ok = TB.drop_invalid(TB.standardize(_as_export(spark, sf_dir)))
    return ok.select("complaint_id", "category", F.length("text").cast("bigint").alias("chars"))


@query("dataset_summary", f"""WITH {_EXPORT} SELECT count(*) AS total_rows, 4::INTEGER AS total_columns, count(*) FILTER ({_BLANK}) AS missing_text_count,
 count(*) FILTER (product IS NULL) AS missing_category_count, count(*) FILTER (id IS NULL) AS missing_id_count,
 count(*) FILTER (NOT {_BLANK} AND product IS NOT NULL) AS usable_rows_count, count(DISTINCT product) AS num_unique_categories FROM export""")
def dataset_summary(spark, sf_dir):
    return P.dataset_summary(_as_export(spark, sf_dir), "Consumer Complaint", "Product", "Complaint ID")


@query("top_categories", f"WITH {_EXPORT} SELECT product AS value, count(*) AS n FROM export WHERE product IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 8")
def top_categories(spark, sf_dir):
    return P.top_values(_as_export(spark, sf_dir), "Product")


@query("category_counts", "SELECT source AS value, count(*) AS n FROM documents GROUP BY 1")
def category_counts(spark, sf_dir):
    return P.top_values(table(spark, sf_dir, "documents"), "source", None)


@query("missing_values", f"""WITH {_EXPORT} SELECT * FROM (SELECT 'Product' AS "column", count(*) FILTER (product IS NULL) AS missing,
 round(count(*) FILTER (product IS NULL) * 100.0::DOUBLE / count(*), 6) AS missing_pct FROM export UNION ALL
 SELECT 'Issue', count(*) FILTER (issue IS NULL), round(count(*) FILTER (issue IS NULL) * 100.0::DOUBLE / count(*), 6) FROM export)
 WHERE missing > 0""")
def missing_values(spark, sf_dir):
    return P.missing_values(_as_export(spark, sf_dir))


def _hit_pages(spark, sf_dir):
    """Each conversation as one page of hits, written as JSON text and parsed back."""
    turns = table(spark, sf_dir, "conversations")
    source = F.struct(
        F.when(F.col("turn") > 0, F.concat_ws("-", "conv_id", "turn")).alias("complaint_id"),
        F.when(F.col("role") == "user", "Question").when(F.col("role") == "assistant", "").alias("product"),
        F.col("role").alias("issue"), F.when(F.length("text") > 40, F.concat(F.lit(" "), "text", F.lit("\n"))).alias("complaint_what_happened"))
    hit = F.struct(F.concat(F.lit("h"), F.concat_ws("-", "conv_id", "turn")).alias("_id"), source.alias("_source"))
    per = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", hit.alias("hit")))).alias("x"))
    doc = F.to_json(F.struct(F.struct(F.col("x.hit").alias("hits")).alias("hits")))
    return per.select("conv_id", F.from_json(doc, PG.PAGE_SCHEMA).alias("page")).select("conv_id", "page.hits")


_HITS = f"""hits AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS pos,
 CASE WHEN turn > 0 THEN conv_id || '-' || turn ELSE 'h' || conv_id || '-' || turn END AS complaint_id,
 CASE WHEN role = 'user' THEN 'Question' ELSE 'Unspecified' END AS category,
 CASE WHEN length(text) > 40 THEN {S.rx(S.rx('text', S.FIRST_BLANKS, ''), S.LAST_BLANKS, '')} ELSE '' END AS text, role AS issue FROM conversations)"""


@query("normalized_hits", f"WITH {_HITS} SELECT complaint_id, category, text, issue FROM hits")
def normalized_hits(spark, sf_dir):
    return PG.hits_of(_hit_pages(spark, sf_dir), ["conv_id"]).select("complaint_id", "category", "text", "issue")


@query("collected_hits", f"WITH {_HITS} SELECT complaint_id, category, issue FROM hits WHERE text <> '' ORDER BY conv_id, pos LIMIT 200")
def collected_hits(spark, sf_dir):
    return PG.collect(_hit_pages(spark, sf_dir), ["conv_id"], 200, drop_empty=True).select("complaint_id", "category", "issue")


@query("product_and_term_filter", "SELECT doc_id, lang, source FROM documents WHERE lang = 'en' AND contains(lower(text), 'the on')")
def product_and_term_filter(spark, sf_dir):
    return TB.filter_records(table(spark, sf_dir, "documents"), " en ", "The On", category="lang").select("doc_id", "lang", "source")


@query("taxonomy_table", f"SELECT category, normalized_category FROM ({S.mapping('sources_narrow')}) WHERE category IN (SELECT source FROM documents)")
def taxonomy_table(spark, sf_dir):
    groups = load_taxonomy(spark, f"{CONFIG}/sources_narrow.json").select("category", "normalized_category")
    return groups.join(table(spark, sf_dir, "documents"), F.col("category") == F.col("source"), "left_semi")


_ENTRIES = ", ".join(f"({', '.join(S.literal(x) for x in (k, v['normalized_category'], v['evidence_type'], v.get('cfpb_source'), v.get('evidence_description')))})"
                     for k, v in sorted(read_entries("sources_narrow").items()))


@query("taxonomy_rationale", f"""SELECT category, normalized_category, evidence_type, m.source, rationale, count(doc_id) AS rows FROM (VALUES {_ENTRIES}) AS m(category, normalized_category, evidence_type, source, rationale)
 LEFT JOIN documents d ON d.source = category GROUP BY ALL""")
def taxonomy_rationale(spark, sf_dir):
    """Why each label maps to its group, with the number of its records."""
    n = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("category")).agg(F.count("doc_id").alias("rows"))
    entries = taxonomy_entries(spark, f"{CONFIG}/sources_narrow.json")
    return entries.join(n, "category", "left").select(*entries.columns, F.coalesce("rows", F.lit(0)).alias("rows"))


@query("picked_percentages", """SELECT category, CASE WHEN pct <= 1 THEN pct * 100.0 ELSE pct END::DOUBLE AS percent FROM
 (SELECT source AS category, count(*) * 100 // (SELECT count(*) FROM documents) AS pct FROM documents GROUP BY 1) WHERE category LIKE '%rc1%'""")
def picked_percentages(spark, sf_dir):
    """Shares of the classes as a report prints them, read back as numbers, for the rows that a text picks."""
    d = table(spark, sf_dir, "documents")
    n = d.groupBy(F.col("source").alias("category")).agg(F.count("*").alias("n"))
    shown = n.select("category", F.concat(F.floor(F.col("n") * 100 / d.agg(F.count("*")).scalar()).cast("string"), F.lit("%")).alias("share"))
    return pick_rows(shown, {"category": "RC1"}).select("category", as_percent(F.col("share")).alias("percent"))


@query("open_grid_cells", "SELECT lang, source FROM (SELECT DISTINCT lang, source FROM documents) WHERE (lang, source) NOT IN "
       "(SELECT (lang, source) FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)")
def open_grid_cells(spark, sf_dir):
    from narrata.sources.artifacts import open_cells

    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    done = d.join(table(spark, sf_dir, "labels").filter("toxic = 1"), "doc_id")
    return open_cells(d.select("lang", "source").distinct(), done, ["lang", "source"])


@query("record_count", "SELECT count(*) AS n FROM documents")
def record_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("n"))


@query("record_preview", "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 25")
def record_preview(spark, sf_dir):
    return TB.preview(table(spark, sf_dir, "documents"), "doc_id", 25).select("doc_id", "lang", "source", "n_chars")


@query("record_by_id", "SELECT doc_id, lang, source, text FROM documents WHERE doc_id = 7")
def record_by_id(spark, sf_dir):
    return TB.by_id(table(spark, sf_dir, "documents"), "doc_id", 7).select("doc_id", "lang", "source", "text")


# ---- text functions ----


@query("clean_standard", f"SELECT doc_id, {S.cleaned('text')} AS cleaned FROM documents")
def clean_standard(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.clean("text").alias("cleaned"))


@query("clean_standard_html", f"SELECT page_id, {S.cleaned('html')} AS cleaned, {S.cleaned('url')} AS cleaned_url FROM pages")
def clean_standard_html(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.clean("html").alias("cleaned"), T.clean("url").alias("cleaned_url"))


@query("clean_minimal", f"SELECT doc_id, {S.minimal('text')} AS cleaned FROM documents")
def clean_minimal(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.clean("text", "minimal").alias("cleaned"))


@query("tokens", f"SELECT doc_id, len({S.words(S.cleaned('text'))}) AS n, md5(array_to_string({S.words(S.cleaned('text'))}, '|')) AS digest FROM documents")
def tokens(spark, sf_dir):
    t = T.tokens("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(t).cast("bigint").alias("n"), F.md5(F.array_join(t, "|")).alias("digest"))


_OWN = ["the", "of", "le", "der"]


@query("stopwords_removed", f"""SELECT doc_id, len({S.without_stopwords(S.cleaned('text'))}) AS n, len({S.without_stopwords(S.cleaned('text'), _OWN)}) AS n_own,
 md5(array_to_string({S.without_stopwords(S.cleaned('text'))}, '|')) AS digest FROM documents""")
def stopwords_removed(spark, sf_dir):
    kept = T.drop_stopwords(T.tokens("text"))
    own = T.drop_stopwords(T.tokens("text"), _OWN)
    return table(spark, sf_dir, "documents").select("doc_id", F.size(kept).cast("bigint").alias("n"),
                                                    F.size(own).cast("bigint").alias("n_own"), F.md5(F.array_join(kept, "|")).alias("digest"))


@query("preprocess_standard", f"SELECT doc_id, {S.processed('text')} AS processed FROM documents")
def preprocess_standard(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.preprocess("text").alias("processed"))


@query("preprocess_conversations", f"SELECT conv_id, turn, {S.processed('text')} AS processed FROM conversations")
def preprocess_conversations(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.preprocess("text").alias("processed"))


@query("cleaning_variants", " UNION ALL ".join(
    f"SELECT doc_id, '{k}' AS variant, length({v}) AS chars, md5({v}) AS digest FROM documents" for k, v in S.variants("text").items()))
def cleaning_variants(spark, sf_dir):
    v = T.variants("text")
    wide = table(spark, sf_dir, "documents").select("doc_id", *[c.alias(k) for k, c in v.items()])
    long = wide.unpivot("doc_id", list(v), "variant", "cleaned")
    return long.select("doc_id", "variant", F.length("cleaned").cast("bigint").alias("chars"), F.md5("cleaned").alias("digest"))


@query("text_statistics", f"""SELECT doc_id, round(ln(1.0 + length(lower(text))) / 10.0, 6) AS log_length,
 round(least(ln(1.0 + {S.mask_count('text')}), 5.0) / 5.0, 6) AS log_masks, CASE WHEN {S.mask_count('text')} > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS has_mask FROM documents""")
def text_statistics(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", *[c.alias(k) for k, c in T.text_statistics("text").items()])


@query("length_reduction", f"""SELECT doc_id, {S.word_count('text')} AS raw_words, {S.word_count(S.processed('text'))} AS clean_words, length(text) AS raw_chars,
 length({S.processed('text')}) AS clean_chars, round(CASE WHEN length(text) = 0 THEN 0.0 ELSE (length(text) - length({S.processed('text')})) * 100.0::DOUBLE / length(text) END, 6) AS reduction_pct FROM documents""")
def length_reduction(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text", T.preprocess("text").alias("p"))
    raw, kept = F.length("text"), F.length("p")
    return d.select("doc_id", T.word_count("text").cast("bigint").alias("raw_words"), T.word_count("p").cast("bigint").alias("clean_words"),
                    raw.cast("bigint").alias("raw_chars"), kept.cast("bigint").alias("clean_chars"),
                    F.coalesce(F.try_divide((raw - kept) * 100.0, raw), F.lit(0.0)).alias("reduction_pct"))


# the tables hold no masks, so whole upper-case words stand in for them
_MASKED = "regexp_replace(text, ' [A-Z][a-z]{1,2} ', ' XXXX ', 'g')"


@query("redaction_masks", f"""SELECT count(*) FILTER (m > 0) AS with_redaction, round(avg(m), 6) AS mean_redactions, sum(m)::BIGINT AS redactions
 FROM (SELECT {S.mask_count(_MASKED)} AS m FROM documents)""")
def redaction_masks(spark, sf_dir):
    masked = F.regexp_replace("text", " [A-Z][a-z]{1,2} ", " XXXX ")
    m = table(spark, sf_dir, "documents").select(T.mask_count(masked).alias("m"))
    return m.agg(F.count_if(F.col("m") > 0).alias("with_redaction"), F.avg("m").alias("mean_redactions"), F.sum("m").alias("redactions"))


_FIRST6 = "array_to_string(regexp_extract_all(regexp_replace(lower(text), '[^a-z0-9 ]', ' ', 'g'), '\\S+')[1:6], ' ')"


@query("first_words", f"SELECT doc_id, {_FIRST6} AS template FROM documents")
def first_words(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.template("text").alias("template"))


@query("top_templates", f"SELECT {_FIRST6} AS value, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, value LIMIT 8")
def top_templates(spark, sf_dir):
    return P.top_values(table(spark, sf_dir, "documents"), T.template("text"))


@query("cleaning_trace", f"""SELECT doc_id, {S.cleaned('text')} AS cleaned, array_to_string({S.words(S.cleaned('text'))}, '|') AS tokens,
 array_to_string({S.without_stopwords(S.cleaned('text'))}, '|') AS kept, {S.processed('text')} AS processed, {S.word_count('text')} AS n_raw_words,
 len({S.words(S.cleaned('text'))}) AS n_tokens, len({S.without_stopwords(S.cleaned('text'))}) AS n_kept FROM documents""")
def cleaning_trace(spark, sf_dir):
    t = T.stage_trace("text")
    d = table(spark, sf_dir, "documents").select("doc_id", *[c.alias(k) for k, c in t.items()])
    return d.select("doc_id", "cleaned", F.array_join("tokens", "|").alias("tokens"), F.array_join("kept", "|").alias("kept"), "processed",
                    *[F.col(c).cast("bigint").alias(c) for c in ("n_raw_words", "n_tokens", "n_kept")])


_WORDS_EN = r"\b(the|and|on|or)\b"
_LEX = {**T.LEXICONS, "articles": _WORDS_EN}


@query("lexicon_flags", "SELECT source, count(*) AS n, " + ", ".join(
    f"count(*) FILTER ({S.has_word(p)}) AS {k}" for k, p in _LEX.items()) + " FROM documents GROUP BY 1")
def lexicon_flags(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(
        F.count("*").alias("n"), *[F.count_if(T.has_lexicon("text", p)).alias(k) for k, p in _LEX.items()])


@query("negation_prevalence", "SELECT round(avg(CASE WHEN regexp_matches(lower(text), '\\bnot\\b|n''t|\\bno\\b|\\bnever\\b') THEN 100.0::DOUBLE ELSE 0.0 END), 6) AS negation_pct FROM conversations")
def negation_prevalence(spark, sf_dir):
    return table(spark, sf_dir, "conversations").agg((F.avg(T.has_negation("text").cast("double")) * 100).alias("negation_pct"))


def _dated_text(spark, sf_dir):
    """Order dates spelt in several ways, by priority, and not at all for one status."""
    d = F.col("o_orderdate")
    spelt = (F.when(F.col("o_orderstatus") == "P", "not given").when(F.col("o_orderpriority") == "1-URGENT", F.date_format(d, "MM/dd/yyyy"))
             .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(d, "MMMM d, yyyy"))
             .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
             .when(F.col("o_orderpriority") == "5-LOW", F.date_format(d, "yyyyMMdd")).otherwise(F.date_format(d, "yyyy-MM-dd")))
    return table(spark, sf_dir, "orders").select("o_orderkey", spelt.alias("received"))


@query("parsed_dates", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS received FROM orders")
def parsed_dates(spark, sf_dir):
    return _dated_text(spark, sf_dir).select("o_orderkey", D.parse_date(F.col("received")).alias("received"))


@query("date_range", "SELECT count(*) FILTER (o_orderstatus = 'P') AS parse_failures, CAST(min(o_orderdate) FILTER (o_orderstatus <> 'P') AS DATE) AS date_min, "
       "CAST(max(o_orderdate) FILTER (o_orderstatus <> 'P') AS DATE) AS date_max FROM orders")
def date_range(spark, sf_dir):
    d = _dated_text(spark, sf_dir).select(D.parse_date(F.col("received")).alias("d"))
    return d.agg(F.count_if(F.col("d").isNull()).alias("parse_failures"), F.min("d").alias("date_min"), F.max("d").alias("date_max"))


@query("snippets", """SELECT doc_id, replace(substring(text, 1, 220), chr(10), ' ') || CASE WHEN length(text) > 220 THEN '...' ELSE '' END AS snippet,
 replace(substring(text, 1, 120), chr(10), ' ') || CASE WHEN length(text) > 120 THEN '...' ELSE '' END AS short FROM documents""")
def snippets(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.snippet("text").alias("snippet"), T.snippet("text", 120).alias("short"))


# ---- profiles ----


@query("duplicate_counts", "SELECT count(*) AS rows, count(*) - count(DISTINCT doc_id) AS duplicate_ids, count(*) - count(DISTINCT text) AS duplicate_texts FROM documents")
def duplicate_counts(spark, sf_dir):
    return P.duplicate_counts(table(spark, sf_dir, "documents"), "doc_id", "text")


_GROUPS = f"""g AS (SELECT c, count(*) AS size, array_to_string(list_sort(list(DISTINCT source)), '; ') AS labels, count(DISTINCT source) AS k
 FROM (SELECT source, {S.processed('text')} AS c FROM documents) WHERE c <> '' GROUP BY c HAVING count(*) > 1)"""


def _groups(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", T.preprocess("text").alias("c"))
    return P.duplicate_groups(d, "c", "source")


@query("duplicate_group_summary", f"WITH {_GROUPS} SELECT coalesce(sum(size), 0)::BIGINT AS rows_in_groups, count(*) AS groups, count(*) FILTER (k > 1) AS label_conflict_groups FROM g")
def duplicate_group_summary(spark, sf_dir):
    return P.duplicate_summary(_groups(spark, sf_dir))


@query("duplicate_conflict_examples", f"WITH {_GROUPS} SELECT sha256(c) AS digest, size, labels FROM g WHERE k > 1 ORDER BY digest LIMIT 10")
def duplicate_conflict_examples(spark, sf_dir):
    return P.conflict_examples(_groups(spark, sf_dir))


@query("duplicate_variant_conflicts", f"""WITH {_GROUPS}, m AS ({S.mapping('sources_narrow')}), x AS (SELECT c, count(DISTINCT normalized_category) AS k FROM
 (SELECT c, unnest(string_split(labels, '; ')) AS l FROM g WHERE k > 1) JOIN m ON l = category GROUP BY c)
 SELECT count(*) AS conflict_groups, count(*) FILTER (k = 1) AS variant_only_conflicts FROM x""")
def duplicate_variant_conflicts(spark, sf_dir):
    return P.variant_only_conflicts(_groups(spark, sf_dir), load_taxonomy(spark, f"{CONFIG}/sources_narrow.json"))


@query("word_count_profile", f"""WITH w AS (SELECT {S.word_count('text')}::DOUBLE AS v FROM documents) SELECT """ + ", ".join(
    f"round(quantile_cont(v, {p}), 6) AS p{round(p * 100):02d}" for p in P.WORD_QUANTILES) + """, count(*) FILTER (v < 10) AS lt10, count(*) FILTER (v < 20) AS lt20,
 count(*) FILTER (v > 500) AS gt500, count(*) FILTER (v > 1000) AS gt1000 FROM w""")
def word_count_profile(spark, sf_dir):
    return P.word_count_profile(table(spark, sf_dir, "documents"), T.word_count("text"))


@query("empty_texts", f"WITH {_EXPORT} SELECT count(*) FILTER ({_BLANK}) AS empty_narratives, count(*) FILTER ({S.processed('txt')} = '') AS empty_after_cleaning FROM export")
def empty_texts(spark, sf_dir):
    d = _as_export(spark, sf_dir)
    return d.agg(F.count_if(T.is_blank("Consumer Complaint")).alias("empty_narratives"),
                 F.count_if(T.preprocess("Consumer Complaint") == "").alias("empty_after_cleaning"))


@query("category_lifespans", """SELECT o_orderpriority AS category, CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date,
 round(quantile_cont((CAST(o_orderdate AS DATE) - DATE '1970-01-01')::DOUBLE, 0.5), 6) AS median_day, count(*) AS rows FROM orders GROUP BY 1""")
def category_lifespans(spark, sf_dir):
    d = table(spark, sf_dir, "orders").select("o_orderpriority", F.unix_date(F.to_date("o_orderdate")).alias("day"))
    s = temporal.lifespans(d, "o_orderpriority", "day")
    return s.select(F.col("o_orderpriority").alias("category"), F.date_from_unix_date("first_day").alias("first_date"),
                    F.date_from_unix_date("last_day").alias("last_date"), "median_day", "rows")


def _grid(period: str, kind: str) -> str:
    return (f"WITH c AS (SELECT o_orderpriority AS category, {period} AS period, count(*) AS n FROM orders GROUP BY ALL) SELECT category, period, "
            f"coalesce(n, 0) AS n FROM (SELECT DISTINCT category FROM c) CROSS JOIN (SELECT DISTINCT period FROM c) LEFT JOIN c USING (category, period)")


@query("category_by_year", _grid("year(o_orderdate)::INTEGER", ""))
def category_by_year(spark, sf_dir):
    return temporal.crosstab(table(spark, sf_dir, "orders"), "o_orderpriority", F.year("o_orderdate"))


@query("category_by_month", _grid("strftime(o_orderdate, '%Y-%m')", ""))
def category_by_month(spark, sf_dir):
    return temporal.crosstab(table(spark, sf_dir, "orders"), "o_orderpriority", D.month(F.col("o_orderdate")))


@query("metadata_profile", f"""WITH {_EXPORT} SELECT 'Issue' AS "column", round(count(*) FILTER (issue IS NULL) * 100.0::DOUBLE / count(*), 6) AS missing_pct,
 count(DISTINCT issue) AS distinct_values FROM export UNION ALL SELECT 'Product', round(count(*) FILTER (product IS NULL) * 100.0::DOUBLE / count(*), 6), count(DISTINCT product) FROM export""")
def metadata_profile(spark, sf_dir):
    return P.metadata_profile(_as_export(spark, sf_dir), ["Issue", "Product"])


@query("key_purity", """WITH c AS (SELECT o_custkey AS k, o_orderpriority AS l, count(*) AS n FROM orders GROUP BY ALL), p AS (SELECT k, max(n) AS top, sum(n) AS rows, count(*) AS labels FROM c GROUP BY k)
 SELECT count(*) AS keys, round(sum(top)::DOUBLE / sum(rows), 6) AS purity, round(avg(CASE WHEN labels = 1 THEN 100.0::DOUBLE ELSE 0.0 END), 6) AS single_label_pct FROM p""")
def key_purity(spark, sf_dir):
    from narrata.operators.lookup import key_purity as purity

    return purity(table(spark, sf_dir, "orders"), F.col("o_custkey"), "o_orderpriority")


@query("first_records_per_class", "SELECT doc_id, source, rank FROM (SELECT doc_id, source, (row_number() OVER (PARTITION BY source ORDER BY doc_id))::INTEGER AS rank FROM documents) WHERE rank <= 20")
def first_records_per_class(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    return first_per_key(d, ["source"], [F.asc("doc_id")], 20)
