"""Distinct profiles, posts and label excerpts on odd rows."""

from attestra.operators.material import distinct_excerpts
from attestra.operators.ranking import distinct_handles, distinct_posts

LINKS = [(1, "p", "https://nitter.net/Lab/"), (2, "p", "https://www.nitter.net/@lab#x"), (3, "p", " https://nitter.net/Other/media#f "), (4, "q", "https://nitter.net/LAB"), (5, "p", None), (6, "p", ""),
         (7, "p", "https://nitter.net/lab/status/9"), (8, "p", "https://nitter.net/search?q=a"), (9, "q", "https://x.org/lab"), (4, "q", "https://nitter.net/LAB"), (10, "q", "https://nitter.net/lab/status/9#m"),
         (11, "p", "https://nitter.net/z/status/9?x"), (12, None, "https://nitter.net/Lab")]


def test_profiles_and_posts(spark):
    df = spark.createDataFrame(LINKS, "id int, project string, url string").repartition(4)
    got = {(r.project, r.handle, r.link, r.first) for r in distinct_handles(df, "url", "id", ["project"]).collect()}
    assert got == {("p", "Lab", "https://nitter.net/Lab", 1), ("p", "Other", "https://nitter.net/Other/media", 3), ("q", "LAB", "https://nitter.net/LAB", 4), (None, "Lab", "https://nitter.net/Lab", 12)}
    assert {(r.handle, r.first) for r in distinct_handles(df, "url", "id").collect()} == {("Lab", 1), ("Other", 3)}
    ids = lambda out: sorted(r.id for r in out.collect())
    assert ids(distinct_posts(df, "url", ["id"])) == [1, 2, 3, 4, 4, 5, 6, 7, 8, 9, 12]
    assert ids(distinct_posts(df, "url", ["id"], ["project"])) == [1, 2, 3, 4, 4, 5, 6, 7, 8, 9, 10, 12]
    assert distinct_handles(df.filter("false"), "url", "id").count() == distinct_posts(df.filter("false"), "url", ["id"]).count() == 0


def test_excerpts(spark):
    rows = [(2, "a", ["xx1", None, " ", "y"]), (1, "a", ["z", "xx2"]), (1, "a", ["z", "xx2"]), (3, None, ["xx1", ""]), (4, "a", None), (5, "a", [])]
    df = spark.createDataFrame(rows, "id int, name string, texts array<string>").repartition(4)
    got = {(r.name, r.excerpt, r.first, r.pos) for r in distinct_excerpts(df, ["name"], "id", "texts", 2).collect()}
    assert got == {("a", "xx", 1, 1), ("a", "z", 1, 0), ("a", "y", 2, 3), (None, "xx", 3, 0)}
    assert distinct_excerpts(df.filter("false"), ["name"], "id", "texts").count() == 0
