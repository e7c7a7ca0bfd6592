"""Files of any form are made and parsed once, whichever forms are read from them."""

from pyspark.sql import functions as F

from attestra.sources.material import material_rows

FORMS = ['{"source_type":"a","content":{"x":1}}\n\n{"source_type":"b","content":{}}', '{"records":[{"source_type":"c","content":{"x":2}}, 7]}', '{"report":{"compound_name":"d"}}', '{"compound_name":"e"}', "no json", "", None]


def test_files_are_made_once(spark):
    files = spark.range(len(FORMS)).select("id", F.get(F.array(*[F.lit(t) for t in FORMS]), F.col("id").cast("int")).alias("value"))
    rows = material_rows(files, keep=("id",))
    assert "Range" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.id, r.seq, r.source_type) for r in rows.collect()) == [(0, 0, "a"), (0, 2, "b"), (1, 0, "c"), (2, 0, "compound_name"), (3, 0, "compound_name")]
