"""Views on literal rows: search by both ways, against a loop."""

from pyspark.sql import functions as F

from gleanery.operators import views


def test_search_sends_the_queries_not_the_index(spark, tmp_path):
    """An index in small files, which Spark would broadcast once cut into pieces."""
    words = ["red", "ready", "small", "ring", "gear", "or"]
    titles = [f"{words[i % 6]} {words[i * 5 % 6]} {i % 7}" for i in range(300)]
    spark.createDataFrame([(i, t, f"{t} brand {i % 3}", float(i % 2)) for i, t in enumerate(titles)], "id long, title string, hay string, bonus double").write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    asked = [(1, ["red"]), (2, ["ready", "brand"]), (3, ["or"]), (4, ["gear", "2"]), (5, []), (6, ["nowhere"])]
    queries = spark.createDataFrame(asked, "q int, tokens array<string>")
    want = []
    for q, tokens in asked:
        found = [(sum(3 if t.startswith(k) else 2 if k in t else 1 for k in tokens) + i % 2, i) for i, t in enumerate(titles) if tokens and all(k in f"{t} brand {i % 3}" for k in tokens)]
        want += [(q, i, float(s)) for s, i in sorted(found, key=lambda x: (-x[0], x[1]))[:5]]
    for few in (10, 0):
        got = views.search(queries, index, 5, few).select("q", "id", F.col("score"))
        assert sorted(map(tuple, got.collect())) == sorted(want)
        plan = got._jdf.queryExecution().executedPlan().toString()
        sent = [plan[at:].split("\n")[0:3] for at in range(len(plan)) if plan.startswith("BroadcastExchange", at)]
        assert not any("Generate" in line for lines in sent for line in lines)
        assert few or not sent
