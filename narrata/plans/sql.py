"""SQL fragments for the twins of the registered queries."""

from __future__ import annotations

from narrata.functions.text import KEPT_NEGATIONS, STOPWORDS
from narrata.sources.taxonomy import read_config


# Patterns shared with the text functions, as SQL writes them (a quote is doubled).
NEGATED = r"n''t\b"
BLANK_RUN = r"\s+"
FIRST_BLANKS, LAST_BLANKS = r"^[\s]+", r"[\s]+$"


def text_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in sorted(values)) + ")"


def literal(value: str | None) -> str:
    return "NULL::VARCHAR" if value is None else "'" + value.replace("'", "''") + "'"


def rx(t: str, pattern: str, to: str = " ") -> str:
    return f"regexp_replace({t}, '{pattern}', '{to}', 'g')"


def blanks(t: str) -> str:
    """Every kind of white space as a plain blank, so that \\s and \\S see it."""
    return rx(f"coalesce({t}, '')", r"[\x0b\x1c-\x1f\x{85}\p{Z}]")


def cleaned(t: str, mask: str = " ", negation: bool = False, symbols: dict | None = None) -> str:
    t = rx(rx(f"lower({blanks(t)})", r"https?://\S+|www\.\S+"), r"\S+@\S+")
    if negation:
        t = f"replace({rx(t, NEGATED, ' not')}, 'cannot', 'can not')"
    for symbol, word in (symbols or {}).items():
        t = f"replace({t}, '{symbol}', ' {word} ')"
    t = rx(t, r"[^a-zA-Z0-9\s]")
    t = rx(t, r"\bx{2,}\b", mask)
    return f"trim({rx(t, BLANK_RUN)})"


def minimal(t: str) -> str:
    return f"trim({rx(f'lower({blanks(t)})', BLANK_RUN)})"


def words(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda w: w <> '')"


def without_stopwords(c: str, stopwords=STOPWORDS) -> str:
    return f"list_filter(string_split({c}, ' '), lambda w: w <> '' AND w NOT IN {text_list(stopwords)})"


def lean(c: str, stopwords=STOPWORDS) -> str:
    return f"array_to_string({without_stopwords(c, stopwords)}, ' ')"


def processed(t: str) -> str:
    return lean(cleaned(t))


NOT_NEGATIONS = STOPWORDS - set(KEPT_NEGATIONS)


def variants(t: str) -> dict[str, str]:
    return {
        "A": processed(t), "B": minimal(t), "C": cleaned(t),
        "D": lean(cleaned(t, symbols={"!": "exclamationmark", "?": "questionmark"})),
        "E": lean(cleaned(t, symbols={"$": "dollarsign", "%": "percentsign"})),
        "F": lean(cleaned(t, negation=True), NOT_NEGATIONS),
        "G": lean(cleaned(t, mask=" redactedmask ")),
    }


def mask_count(t: str) -> str:
    """Whole words of x only; words end where no letter, digit or underscore follows."""
    return f"len(list_filter(regexp_split_to_array(lower({t}), '[^\\p{{L}}\\p{{N}}_]+'), lambda w: regexp_full_match(w, 'x{{2,}}')))"


def has_word(pattern: str, t: str = "text") -> str:
    """A word-bounded lexicon pattern with Unicode word ends, which \\b does not know here."""
    inner = pattern.removeprefix(r"\b").removesuffix(r"\b")
    return f"regexp_matches(lower({t}), '(^|[^\\p{{L}}\\p{{N}}_]){inner}($|[^\\p{{L}}\\p{{N}}_])')"


def word_count(t: str) -> str:
    return f"len(regexp_extract_all({blanks(t)}, '\\S+'))"


def _runs(low: int, high: int, sep: str) -> str:
    """Lists of neighbours in the list column ``t``."""
    out = None
    for n in range(low, high + 1):
        joined = f" || '{sep}' || ".join(f"t[i + {j}]" if j else "t[i]" for j in range(n))
        p = "t" if n == 1 else f"list_transform(range(1, greatest(len(t) - {n - 2}, 1)), lambda i: {joined})"
        out = p if out is None else f"list_concat({out}, {p})"
    return out


def term_counts(src: str, analyzer: str, low: int, high: int, keys: str = "doc_id") -> str:
    """Body of a CTE with (keys, term, tf) from ``src`` (keys, c)."""
    if analyzer == "word":
        lists = f"SELECT {keys}, regexp_extract_all(c, '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM {src}"
        terms = _runs(low, high, " ")
    elif analyzer == "char":
        lists = f"SELECT {keys}, regexp_extract_all(c, '.') AS t FROM {src}"
        terms = _runs(low, high, "")
    elif analyzer == "char_wb":
        lists = (f"SELECT {keys}, regexp_extract_all(' ' || w || ' ', '.') AS t FROM "
                 f"(SELECT {keys}, unnest(string_split(c, ' ')) AS w FROM {src}) WHERE w <> ''")
        terms = f"CASE WHEN len(t) < {low} THEN [array_to_string(t, '')] ELSE {_runs(low, high, '')} END"
    else:
        raise ValueError(analyzer)
    return f"SELECT {keys}, term, count(*) AS tf FROM (SELECT {keys}, unnest({terms}) AS term FROM ({lists})) GROUP BY ALL"


def vocabulary(tf: str, n_docs: str, min_df: int, max_df: float, max_features: int | None = None) -> str:
    body = (f"SELECT term, df, cf, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM (SELECT term, count(*) AS df, "
            f"sum(tf)::BIGINT AS cf FROM {tf} GROUP BY term), (SELECT count(*) AS n FROM {n_docs}) "
            f"WHERE df >= {min_df} AND df <= {max_df} * n")
    return body + (f" ORDER BY cf DESC, term LIMIT {max_features}" if max_features else "")


def weights(tf: str, vocab: str, sublinear: bool = True, norm: str = "l2", keys: str = "doc_id") -> str:
    raw = "(1.0 + ln(tf)) * idf" if sublinear else "tf * idf"
    total = {"l2": "sqrt(sum(r * r) OVER (PARTITION BY doc_id))", "l1": "sum(abs(r)) OVER (PARTITION BY doc_id)"}[norm]
    return f"SELECT {keys}, term, r / {total} AS w FROM (SELECT {keys}, term, {raw} AS r FROM {tf} JOIN {vocab} USING (term))"


def hash60(id: str, seed: int) -> str:
    return f"('0x' || substr(md5('{seed}-' || {id}), 1, 15))::BIGINT"


def split(src: str, id: str, label: str, share: float, seed: int, test: str = "test", train: str = "train") -> str:
    """Body of a CTE (id, label, split) with largest-remainder quotas."""
    return (f"SELECT {id}, {label}, CASE WHEN row_number() OVER (PARTITION BY {label} ORDER BY {hash60(id, seed)}, {id}) <= q "
            f"THEN '{test}' ELSE '{train}' END AS split FROM {src} JOIN (SELECT {label}, f + CASE WHEN row_number() OVER "
            f"(ORDER BY r DESC, {label}) <= nt - sum(f) OVER () THEN 1 ELSE 0 END AS q FROM (SELECT {label}, nt, nt * m // n AS f, "
            f"nt * m % n AS r FROM (SELECT {label}, count(*) AS m FROM {src} GROUP BY 1), (SELECT count(*) AS n, "
            f"ceil({share} * count(*))::BIGINT AS nt FROM {src}))) USING ({label})")


def mapping(name: str) -> str:
    """Body of a CTE (category, normalized_category)."""
    rows = ", ".join(f"('{k}', '{v}')" for k, v in sorted(read_config(name).items()))
    return f"SELECT * FROM (VALUES {rows}) AS t(category, normalized_category)"


def corpus(label: str = "source") -> str:
    """CTEs: docs (doc_id, label, c) with processed text, and parts with the 80 / 20 split."""
    return (f"docs AS (SELECT doc_id, {label} AS label, {processed('text')} AS c FROM documents), "
            f"parts AS ({split('docs', 'doc_id', 'label', 0.2, 42, 'test', 'pool')}), "
            "pool AS (SELECT docs.* FROM docs JOIN parts USING (doc_id) WHERE split = 'pool'), "
            "held AS (SELECT docs.* FROM docs JOIN parts USING (doc_id) WHERE split = 'test')")


def bayes(name: str, pool: str = "pool", held: str = "held", kind: str = "multinomial", alpha: float = 0.1,
          vocab_from: str | None = None, analyzer: str = "word", low: int = 1, high: int = 1, min_df: int = 2) -> str:
    """CTEs ``{name}_...`` ending in ``{name}`` (doc_id, y_true, y_pred, conf) and ``{name}_scores``."""
    n = name
    return f"""
{n}_tf AS ({term_counts(pool, analyzer, low, high, 'doc_id, label')}),
{n}_v AS ({vocabulary(n + '_tf', pool, min_df, 0.95)}),
{n}_w AS ({weights(n + '_tf', n + '_v', keys='doc_id, label')}),
{n}_htf AS ({term_counts(held, analyzer, low, high)}),
{n}_hw AS ({weights(n + '_htf', n + '_v')}),{bayes_of_weights(n, pool, held, kind, alpha)}"""


def bayes_of_weights(name: str, pool: str, held: str, kind: str = "multinomial", alpha: float = 0.1) -> str:
    """As ``bayes``, from CTEs of weights: {name}_v (term), {name}_w (doc_id, label, term, w) and {name}_hw (doc_id, term, w)."""
    n = name
    theta = ("ln((coalesce(s, 0.0) + {a}) / (st + {a} * v))" if kind == "multinomial"
             else "-ln((tt - coalesce(s, 0.0) + {a}) / (gt - st + {a} * v))").format(a=alpha)
    prior = f"ln(m * 1.0 / (SELECT count(*) FROM {pool}))" if kind == "multinomial" else "0.0"
    return f"""
{n}_s AS (SELECT label, term, sum(w) AS s FROM {n}_w GROUP BY ALL),
{n}_c AS (SELECT label, m, coalesce(st, 0.0) AS st, v, gt FROM (SELECT label, count(*) AS m FROM {pool} GROUP BY 1)
  LEFT JOIN (SELECT label, sum(s) AS st FROM {n}_s GROUP BY 1) USING (label),
  (SELECT count(*) AS v FROM {n}_v), (SELECT sum(s) AS gt FROM {n}_s)),
{n}_t AS (SELECT c.label, x.term, {theta} AS theta FROM {n}_c c CROSS JOIN (SELECT term, sum(s) AS tt FROM {n}_s GROUP BY 1) x
  LEFT JOIN {n}_s s ON s.label = c.label AND s.term = x.term),
{n}_dot AS (SELECT doc_id, label, sum(w * theta) AS d FROM {n}_hw JOIN {n}_t USING (term) GROUP BY ALL),
{n}_scores AS (SELECT h.doc_id, h.label AS y_true, c.label, coalesce(d, 0.0) + {prior} AS score
  FROM {held} h CROSS JOIN {n}_c c LEFT JOIN {n}_dot x ON x.doc_id = h.doc_id AND x.label = c.label),
{n}_prob AS (SELECT doc_id, y_true, label, score, e / sum(e) OVER (PARTITION BY doc_id) AS p FROM
  (SELECT *, exp(score - max(score) OVER (PARTITION BY doc_id)) AS e FROM {n}_scores)),
{n} AS (SELECT doc_id, y_true, label AS y_pred, p AS conf FROM {n}_prob
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, label) = 1)"""


def confusion(preds: str) -> str:
    return f"SELECT y_true, y_pred, count(*) AS n FROM {preds} GROUP BY ALL"


def per_class(cells: str) -> str:
    return (f"SELECT category, s::BIGINT AS support, p::BIGINT AS predicted, t::BIGINT AS correct, "
            f"CASE WHEN p = 0 THEN 0.0 ELSE t * 1.0::DOUBLE / p END AS precision, CASE WHEN s = 0 THEN 0.0 ELSE t * 1.0::DOUBLE / s END AS recall, "
            f"CASE WHEN s + p = 0 THEN 0.0 ELSE 2.0::DOUBLE * t / (s + p) END AS f1 FROM (SELECT category, sum(s) AS s, sum(p) AS p, sum(t) AS t FROM ("
            f"SELECT y_true AS category, n AS s, 0 AS p, CASE WHEN y_true = y_pred THEN n ELSE 0 END AS t FROM {cells} UNION ALL "
            f"SELECT y_pred, 0, n, 0 FROM {cells}) GROUP BY 1)")


def summary(classes: str) -> str:
    return (f"SELECT sum(support)::BIGINT AS rows, sum(correct)::DOUBLE / sum(support) AS accuracy, avg(precision) AS macro_precision, "
            f"avg(recall) AS macro_recall, avg(f1) AS macro_f1, sum(precision * support) / sum(support) AS weighted_precision, "
            f"sum(recall * support) / sum(support) AS weighted_recall, sum(f1 * support) / sum(support) AS weighted_f1 FROM {classes}")


METRICS = ("accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1")


def rounded(columns, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) + 0.0 AS {c.split('.')[-1]}" for c in columns)


def metrics_of(preds: str, n: str) -> str:
    """CTEs {n}_cells, {n}_classes and {n}_sum."""
    return (f"{n}_cells AS ({confusion(preds)}), {n}_classes AS ({per_class(n + '_cells')}), "
            f"{n}_sum AS ({summary(n + '_classes')})")


def bayes_grid(name: str, stage: str, low: int, high: int, min_df: int = 2, pool: str = "pool", held: str = "held") -> str:
    """CTEs ending in ``{name}``: metrics of every candidate ``(model, alpha)`` of the CTE ``cand``."""
    n = name
    theta = ("CASE WHEN model = 'multinomial' THEN ln((coalesce(s, 0.0) + alpha) / (st + alpha * v)) "
             "ELSE -ln((tt - coalesce(s, 0.0) + alpha) / (gt - st + alpha * v)) END")
    grouped = (f"SELECT model, alpha, category, sum(s)::BIGINT AS support, sum(p)::BIGINT AS predicted, sum(t)::BIGINT AS correct FROM ("
               f"SELECT model, alpha, y_true AS category, n AS s, 0 AS p, CASE WHEN y_true = y_pred THEN n ELSE 0 END AS t FROM {n}_cells UNION ALL "
               f"SELECT model, alpha, y_pred, 0, n, 0 FROM {n}_cells) GROUP BY ALL")
    return f"""
{n}_tf AS ({term_counts(pool, 'word', low, high, 'doc_id, label')}),
{n}_v AS ({vocabulary(n + '_tf', pool, min_df, 0.95)}),
{n}_w AS ({weights(n + '_tf', n + '_v', keys='doc_id, label')}),
{n}_s AS (SELECT label, term, sum(w) AS s FROM {n}_w GROUP BY ALL),
{n}_c AS (SELECT label, m, coalesce(st, 0.0) AS st, v, gt FROM (SELECT label, count(*) AS m FROM {pool} GROUP BY 1)
  LEFT JOIN (SELECT label, sum(s) AS st FROM {n}_s GROUP BY 1) USING (label), (SELECT count(*) AS v FROM {n}_v), (SELECT sum(s) AS gt FROM {n}_s)),
{n}_t AS (SELECT model, alpha, c.label, x.term, {theta} AS theta FROM cand CROSS JOIN {n}_c c CROSS JOIN (SELECT term, sum(s) AS tt FROM {n}_s GROUP BY 1) x
  LEFT JOIN {n}_s s ON s.label = c.label AND s.term = x.term),
{n}_hw AS ({weights('(' + term_counts(held, 'word', low, high) + ')', n + '_v')}),
{n}_dot AS (SELECT doc_id, model, alpha, label, sum(w * theta) AS d FROM {n}_hw JOIN {n}_t USING (term) GROUP BY ALL),
{n}_best AS (SELECT h.doc_id, h.label AS y_true, model, alpha, c.label AS y_pred FROM {held} h CROSS JOIN cand CROSS JOIN {n}_c c LEFT JOIN {n}_dot x USING (doc_id, model, alpha)
  WHERE x.label IS NULL OR x.label = c.label
  QUALIFY row_number() OVER (PARTITION BY h.doc_id, model, alpha ORDER BY round(coalesce(d, 0.0) + CASE WHEN model = 'multinomial' THEN ln(m * 1.0 / (SELECT count(*) FROM {pool})) ELSE 0.0 END, 9) DESC, c.label) = 1),
{n}_cells AS (SELECT model, alpha, y_true, y_pred, count(*) AS n FROM {n}_best GROUP BY ALL),
{n}_classes AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE correct * 1.0::DOUBLE / predicted END AS precision, CASE WHEN support = 0 THEN 0.0 ELSE correct * 1.0::DOUBLE / support END AS recall,
  CASE WHEN support + predicted = 0 THEN 0.0 ELSE 2.0::DOUBLE * correct / (support + predicted) END AS f1 FROM ({grouped})),
{n} AS (SELECT '{stage}' AS stage, x.* FROM (SELECT model, alpha, sum(correct)::DOUBLE / sum(support) AS accuracy, avg(precision) AS macro_precision,
  avg(recall) AS macro_recall, avg(f1) AS macro_f1, sum(precision * support) / sum(support) AS weighted_precision, sum(recall * support) / sum(support) AS weighted_recall,
  sum(f1 * support) / sum(support) AS weighted_f1 FROM {n}_classes GROUP BY ALL) x)"""
