"""Cleaning, tokenising and measuring text: Column in, Column out, all inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default English stop words.
STOPWORDS = frozenset(
    """
    a about above after again against all am an and any are aren't as at be because been before
    being below between both but by can can't cannot could couldn't did didn't do does doesn't
    doing don't down during each few for from further had hadn't has hasn't have haven't having he
    he'd he'll he's her here here's hers herself him himself his how how's i i'd i'll i'm i've if
    in into is isn't it it's its itself let's me more most mustn't my myself no nor not of off on
    once only or other ought our ours ourselves out over own same shan't she she'd she'll she's
    should shouldn't so some such than that that's the their theirs them themselves then there
    there's these they they'd they'll they're they've this those through to too under until up very
    was wasn't we we'd we'll we're we've were weren't what what's when when's where where's which
    while who who's whom why why's with won't would wouldn't you you'd you'll you're you've your
    yours yourself yourselves
    """.split()
)

# Lexicons that hint at a product.
VEHICLE_WORDS = r"\b(car|vehicle|auto|truck|suv|lease|leased|dealer|dealership|repo|repossess\w*|toyota|honda|ford|nissan|chevy|bmw)\b"
PREPAID_WORDS = r"\b(prepaid|pre-paid|reloadable|green dot|netspend|direct express|gift card|debit card)\b"
BANK_WORDS = r"\b(checking|savings|bank account|overdraft|deposit|atm|debit)\b"
PAYDAY_WORDS = r"\b(payday|pay day|title loan|cash advance|short term|installment loan|personal loan)\b"
CREDIT_WORDS = r"\b(equifax|experian|transunion|credit report|credit bureau|credit score|credit file)\b"
LEXICONS = {
    "vehicle": VEHICLE_WORDS,
    "prepaid": PREPAID_WORDS,
    "bank": BANK_WORDS,
    "payday": PAYDAY_WORDS,
    "credit": CREDIT_WORDS,
}
# Negations, and the words that stand for symbols and masks in the variants.
NEGATION_PATTERN = r"\bnot\b|n't|\bno\b|\bnever\b"
KEPT_NEGATIONS = ("no", "not", "nor", "never")

# Java's \s knows ASCII only; these are the blanks that count as white space in text.
_BLANK = r"\s\x1c-\x1f\x85\p{Z}"
_URL = rf"https?://[^{_BLANK}]+|www\.[^{_BLANK}]+"
# Tried only at the start of a run of non-blanks, so that a long run costs linear time.
_EMAIL = rf"(?<![^{_BLANK}])[^{_BLANK}]+@[^{_BLANK}]+"
_MASK = r"\bx{2,}\b"

MODES = ("standard", "minimal")


def check_mode(mode) -> str:
    if not isinstance(mode, str):
        raise ValueError(f"Cleaning mode must be a string, got {type(mode).__name__}.")
    name = mode.strip().lower()
    if name not in MODES:
        raise ValueError(f"Unsupported cleaning mode '{mode}'. Choose one of {', '.join(MODES)}.")
    return name


def _col(text) -> Column:
    return F.col(text) if isinstance(text, str) else text


def strip(text) -> Column:
    """Remove blanks of every kind on both sides."""
    return F.regexp_replace(_col(text), rf"^[{_BLANK}]+|[{_BLANK}]+$", "")


def is_blank(text) -> Column:
    return ~F.coalesce(_col(text), F.lit("")).rlike(rf"[^{_BLANK}]")


def lowered(text) -> Column:
    return F.lower(F.coalesce(_col(text), F.lit("")))


def _squeeze(text: Column, mask: str = "") -> Column:
    """Lower-case letters and digits, one blank between words; masks become ``mask``."""
    words = F.regexp_replace(text, r"[^a-z0-9]+", " ")
    words = F.regexp_replace(words, _MASK if mask else _MASK + " ?", mask)
    return F.trim(words)


def _without_contacts(text: Column) -> Column:
    """``text`` (in lower case) without URLs and addresses; most texts hold neither and skip the patterns."""
    linked = F.contains(text, F.lit("http")) | F.contains(text, F.lit("www."))
    plain = F.when(linked, F.regexp_replace(text, _URL, " ")).otherwise(text)
    return F.when(F.contains(text, F.lit("@")), F.regexp_replace(plain, _EMAIL, " ")).otherwise(plain)


def clean(text, mode: str = "standard") -> Column:
    """Standard: drop URLs, addresses, symbols and redaction masks. Minimal: blanks only."""
    if check_mode(mode) == "minimal":
        return F.trim(F.regexp_replace(lowered(text), rf"[{_BLANK}]+", " "))
    return _squeeze(_without_contacts(lowered(text)))


def split_words(cleaned: Column) -> Column:
    """Words of a text in which single blanks part the words."""
    return F.filter(F.split(cleaned, " "), lambda w: w != "")


def tokens(text) -> Column:
    return split_words(clean(text))


def drop_stopwords(words: Column, stopwords: Iterable[str] | None = None) -> Column:
    chosen = sorted(STOPWORDS if stopwords is None else stopwords)
    if not chosen:
        return F.filter(words, lambda w: w != "")
    return F.filter(words, lambda w: (w != "") & ~w.isin(chosen))


def preprocess(text, stopwords: Iterable[str] | str | None = None, mode: str = "standard") -> Column:
    """Clean, tokenise, drop stop words and join again; a null text gives ''."""
    if isinstance(stopwords, str) and mode == "standard":
        mode, stopwords = stopwords, None
    if check_mode(mode) == "minimal":
        return clean(text, "minimal")
    return F.array_join(drop_stopwords(tokens(text), stopwords), " ")


def clean_with(text, mask: str = "", negation: bool = False, symbols: Mapping[str, str] | None = None) -> Column:
    """Standard cleaning that can keep masks, spell out negations and name symbols."""
    out = _without_contacts(lowered(text))
    if negation:
        out = F.replace(F.regexp_replace(out, r"(?U)n't\b", " not"), F.lit("cannot"), F.lit("can not"))
    for symbol, word in (symbols or {}).items():
        out = F.replace(out, F.lit(symbol), F.lit(f" {word} "))
    return _squeeze(out, mask)


def variants(text) -> dict[str, Column]:
    """The seven cleaning variants that the preprocessing experiment compares."""

    def lean(cleaned: Column, stopwords=None) -> Column:
        return F.array_join(drop_stopwords(split_words(cleaned), stopwords), " ")

    return {
        "A": preprocess(text),
        "B": clean(text, "minimal"),
        "C": clean(text),
        "D": lean(clean_with(text, symbols={"!": "exclamationmark", "?": "questionmark"})),
        "E": lean(clean_with(text, symbols={"$": "dollarsign", "%": "percentsign"})),
        "F": lean(clean_with(text, negation=True), STOPWORDS - set(KEPT_NEGATIONS)),
        "G": lean(clean_with(text, mask="redactedmask")),
    }


def mask_count(text) -> Column:
    return F.regexp_count(lowered(text), F.lit("(?U)" + _MASK))


def text_statistics(text) -> dict[str, Column]:
    """Length, redaction count and redaction flag of the raw text, scaled to about [0, 1]."""
    masks = mask_count(text)
    return {
        "log_length": F.log1p(F.length(lowered(text))) / 10.0,
        "log_masks": F.least(F.log1p(masks), F.lit(5.0)) / 5.0,
        "has_mask": F.when(masks > 0, 1.0).otherwise(0.0),
    }


def word_count(text) -> Column:
    """Number of runs of non-blanks."""
    return F.regexp_count(F.coalesce(_col(text), F.lit("")), F.lit(rf"[^{_BLANK}]+"))


def template(text, words: int = 6) -> Column:
    """The first words of the text without symbols."""
    return F.substring_index(F.trim(F.regexp_replace(lowered(text), r"[^a-z0-9]+", " ")), " ", words)


def has_lexicon(text, pattern: str) -> Column:
    return lowered(text).rlike("(?U)" + pattern)


def has_negation(text) -> Column:
    return lowered(text).rlike("(?U)" + NEGATION_PATTERN)


def snippet(text, length: int = 220) -> Column:
    """One line of at most ``length`` characters, with an ellipsis where text was cut."""
    body = F.translate(F.substring(_col(text), 1, length), "\n", " ")
    return F.concat(body, F.when(F.length(_col(text)) > length, "...").otherwise(""))


def excerpt(text, length: int = 500) -> Column:
    return strip(F.substring(_col(text), 1, length))


def stage_trace(text) -> dict[str, Column]:
    """What each cleaning step leaves of a text."""
    words = tokens(text)
    kept = drop_stopwords(words)
    return {
        "cleaned": clean(text),
        "tokens": words,
        "kept": kept,
        "processed": F.array_join(kept, " "),
        "n_raw_words": word_count(text),
        "n_tokens": F.size(words),
        "n_kept": F.size(kept),
    }
