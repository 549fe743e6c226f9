import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from narrata.functions import dates as D
from narrata.functions import text as T


def values(spark, inputs, column):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(inputs)], "i int, text string")
    return [r[0] for r in rows.orderBy("i").select(column).collect()]


STANDARD = [
    ("The BANK Lost My Cheque?", "the bank lost my cheque"),
    ("see http://shop.example.net/a?b=1 and www.help.example then call", "see and then call"),
    ("write to jo.doe-7@mail.example today", "write to today"),
    ("On XX/XX/2020 a Mr. XXXX of Xerox phoned me", "on 2020 a mr of xerox phoned me"),
    ("Paid: $19.99 -- twice!! (ref. #77/B)", "paid 19 99 twice ref 77 b"),
    ("\t\ttabs \n\n and   blanks\r\n", "tabs and blanks"),
    ("", ""), ("   ", ""), (None, ""),
    ("foo@bar baz", "baz"), ("@foo a@ x@y@ @a@b end", "foo a end"), ("xx XXX xxa", "xxa"),
]


def test_standard_cleaning(spark):
    assert values(spark, [a for a, _ in STANDARD], T.clean("text")) == [b for _, b in STANDARD]


def test_minimal_cleaning(spark):
    cases = [
        ("\n The BANK \t Lost  My Cheque? ", "the bank lost my cheque?"),
        ("Paid: $19.99 -- twice!! (ref. #77/B)", "paid: $19.99 -- twice!! (ref. #77/b)"),
        ("%% && ;; -- $", "%% && ;; -- $"),
        ("A \xa0 charge \t of €7 \n came", "a charge of €7 came"),
        (None, ""),
    ]
    assert values(spark, [a for a, _ in cases], T.preprocess("text", mode="minimal")) == [b for _, b in cases]
    assert values(spark, ["Did not."], T.preprocess("text", "minimal")) == ["did not."]


def test_preprocess(spark):
    cases = [("The parcel of my neighbour came in 2019.", "parcel neighbour came 2019"), ("An invoice for $80, again!", "invoice 80"),
             (None, ""), (" \n ", ""), ("She didn't call and the shop is closed.", "didn t call shop closed"),
             ("They did NOT answer on Monday", "answer monday")]
    assert values(spark, [a for a, _ in cases], T.preprocess("text")) == [b for _, b in cases]
    assert values(spark, ["the late fee"], T.preprocess("text", ["late"])) == ["the fee"]
    assert len(T.STOPWORDS) == 175


def test_modes(spark):
    for bad in ("unsupported", 3, None):
        with pytest.raises(ValueError):
            T.clean("text", bad)
    assert T.check_mode("  Minimal ") == "minimal"


def test_variants(spark):
    text = "I didn't pay! Why? It cost $5 or 3%. I cannot see XXXX."
    row = spark.createDataFrame([(text,)], "text string").select(*[c.alias(k) for k, c in T.variants("text").items()]).first()
    assert row["C"] == "i didn t pay why it cost 5 or 3 i cannot see"
    assert "exclamationmark" in row["D"] and "questionmark" in row["D"]
    assert "dollarsign 5" in row["E"] and "3 percentsign" in row["E"]
    assert row["F"].split().count("not") == 2
    assert row["G"].endswith("redactedmask")


def test_statistics(spark):
    rows = spark.createDataFrame([("hello XXXX and xx",), ("plain",), (None,)], "text string")
    got = rows.select(*[c.alias(k) for k, c in T.text_statistics("text").items()]).collect()
    assert [r["has_mask"] for r in got] == [1.0, 0.0, 0.0]
    assert got[2]["log_length"] == 0.0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abx @.:/XWw\n\thtps é€9-"), max_size=60), min_size=40, max_size=60))
def test_cleaning_follows_the_rules(spark, texts):
    def rules(t):
        t = t.lower()
        for pattern in (r"https?://\S+|www\.\S+", r"\S+@\S+", r"[^a-zA-Z0-9\s]", r"\bx{2,}\b", r"\s+"):
            t = re.sub(pattern, " ", t)
        return t.strip()

    assert values(spark, texts, T.clean("text")) == [rules(t) for t in texts]


def test_dates(spark):
    given_ = ["2015-03-19", "03/19/2015", "2015-03-19T12:00:00.000Z", "March 19, 2015", "20150319", "soon", None, ""]
    got = values(spark, given_, D.parse_date(F.col("text")))
    assert [str(d) for d in got[:5]] == ["2015-03-19"] * 5 and got[5:] == [None] * 3
