"""Hand-computed cases and the reference behaviours the driver tables do not show."""

from pyspark.sql import functions as F

from attestra.functions import answers as A
from attestra.functions import text as T
from attestra.functions.html import html_to_text
from attestra.operators import lines as L
from attestra.operators import packing as P
from attestra.operators import ranking as K
from attestra.operators import scoring as S


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_citation_numbers_with_bare_tail(spark):
    assert one(spark, T.citation_numbers(F.lit("as shown 3, 5-7. And (2,1) but (see 9)"), 6)) == [1, 2, 3, 5, 6]


def test_expectation_scores(spark):
    df = spark.createDataFrame([("d", "supported", 0.81), ("d", "unsupported", None)], "dimension string, verdict string, relevancy_score double")
    assert S.dimension_scores(df).first().score == round(0.5 * 0.9 * 2 / 7 + 0.5 * 5 / 7, 4)


def test_answers(spark):
    assert one(spark, A.clean_answer(F.lit("<think>a</think> ok"))) == "ok"
    assert one(spark, A.recover_json(F.lit('x {"a": "}"} y'))) == '{"a": "}"}'


def test_html(spark):
    df = spark.createDataFrame([("<p>a &amp; b</p><script>x</script><b>c</b>",)], "h string")
    assert df.select(html_to_text("h").alias("t")).first().t == "a & b\nc"


def test_pack_text(spark):
    long = "One two three. " * 30
    packed = one(spark, P.pack_text(F.lit("a" * 90 + "\n\n" + "b" * 50 + "\n\n" + long.strip()), 100, 20))
    assert packed[0] == "a" * 90 and packed[1] == "b" * 50 and all(len(p) <= 101 for p in packed)


def test_routes_and_names(spark):
    assert one(spark, L.file_route(F.lit("Brand-Guide.pdf"))) == "skip"
    assert one(spark, L.file_route(F.lit("x"), F.lit("video/mp4; q"))) == "video"
    assert one(spark, T.norm_name(F.lit("  ﬁsetin  A"))) == "fisetin a"


def test_distinct_first_keeps_keyless_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "i int, k string")
    assert sorted(r.i for r in K.distinct_first(df, "k", ["i"]).collect()) == [1, 3, 4]
