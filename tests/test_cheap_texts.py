"""Text functions that look first whether there is anything to do give what the plain formulas give; blocks are built by all tasks."""

from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.lexicon import Lexicon
from foliospark.operators import build
from foliospark.plans import online

LEX = Lexicon()
HARD = [
    "", " ", "\n\n\n\n", "a", " a", "a ", " a ", "a ", "a\u0085", "\ta\r\nb\x0bc\fd", "a  b", "a b", "x\n\n\n\ny",
    "SP 90 01", "s p - 9 0 1 2 3", "sp9001x", "SP\n9001", "ſp9001", "FSSB _ 12", "APC١٢", "io42 and IO 42", "EX1", "SV 8012 SP-9001 sv8012", "P 12", "no code 1 2 3",
    "PARAM (NO.1023)  = 5", "AB#1 = X2,", "WORD = BAR (NO. 7)", "AB ٣", "cnc Plc 主轴", "İı ss ß 12", None,
]


def test_equal_to_the_plain_formulas(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(HARD)], "i int, t string")
    t = F.col("t")
    strip = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    spans = lambda c: F.regexp_extract_all(c, F.lit(LEX.code), F.lit(1))
    compact = F.aggregate(F.array_distinct(spans(F.coalesce(t, F.lit("")))), F.coalesce(t, F.lit("")), lambda acc, s: F.replace(acc, s, T.normalize_code(s)))
    canon = strip(F.regexp_replace(F.regexp_replace(F.upper(compact), r"[ \t\r\f\x0B]+", " "), r"\n{3,}", "\n\n"))
    bare = lambda x: F.regexp_replace(F.regexp_replace(x, r"(?U)\s+", " "), "^[ ,.;:]+|[ ,.;:]+$", "")
    params = F.array_sort(F.array_distinct(F.filter(F.transform(F.regexp_extract_all(t, F.lit(LEX.parameter), F.lit(1)), bare), lambda x: (F.length(x) >= 3) & x.rlike("[0-9]"))))
    named = F.filter(F.array(*map(F.lit, LEX.components)), lambda w: F.contains(F.lower(t), F.lower(w)))
    codes = F.array_sort(F.array_distinct(F.transform(spans(t), T.normalize_code)))
    pairs = {"strip": (T.strip(t), strip(t)), "canonical": (T.canonical(t, LEX, False), canon), "codes": (T.codes(t, LEX), codes), "parameters": (T.parameters(t, LEX), params), "components": (T.components(t, LEX.components), named)}
    for row in rows.select("t", *(c.alias(f"{n}_{k}") for n, two in pairs.items() for k, c in zip("ab", two))).collect():
        for n in pairs:
            assert row[f"{n}_a"] == row[f"{n}_b"], (n, row["t"])


def test_slots_are_counted(spark):
    got = spark.createDataFrame([(["AB", "C", "12", "AB"],), ([],)], "x array<string>").select(online.slot_counts(F.col("x")).alias("v")).collect()
    want = [0.0] * online.DIM
    for w in ("AB", "C", "12", "AB"):
        want[(len(w) * 7 + ord(w[0])) % online.DIM] += 1
    assert [r["v"] for r in got] == [want, [0.0] * online.DIM]


def test_blocks_are_built_by_as_many_tasks_as_there_are_partitions(spark):
    items = spark.createDataFrame([(1, 1, "r1", "text", "10 Part 1", None), (1, 1, "r2", "text", "SP-9001 fault", None)], "doc_id long, page_no int, layout_ref string, layout_type string, text string, ocr_confidence double")
    assert "REPARTITION_BY_NUM" in build.build_blocks(items, LEX, unicode=False)._jdf.queryExecution().toString()
