"""What a plan does to large tables: seen on its steps, and on results over repeats."""

from pyspark.sql import functions as F

from quern.operators import identity as I, records as R, registry as G
from quern.sources import registers as S


def steps(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_task_sorts_a_stratum(spark):
    rows = spark.createDataFrame([(i, i % 7, "ab"[i % 2]) for i in range(60)], "id long, o long, s string")
    out = G.spread_sample(rows, "id", "o", F.col("s"), 4, 1)
    plan = steps(out)
    # both lists are cut before they are dealt out by stratum
    assert plan.count("WindowGroupLimit") == 4
    got = sorted((r.turn, r.stratum, r.o) for r in out.collect())
    assert [t for t, _, _ in got] == [1, 2, 3, 4] and [s for _, s, _ in got] in (list("abab"), list("baba")) and len({o for *_, o in got}) == 4


def test_roles_are_read_once(spark):
    body = '{"rollegrupper":[{"type":{"kode":"STYR"},"roller":[{"type":{"kode":"LEDE"},"person":{"navn":{"fornavn":"A","etternavn":"B"}}},{"type":{"kode":"","beskrivelse":" Nestleder "},"enhet":{"navn":"U"}},{"type":{"kode":"DAGL"},"enhet":{"navn":"V"},"avregistrert":true}]}]}'
    df = spark.createDataFrame([(1, body), (2, None)], "id int, body string").select("id", R.leaders(R.roles(F.col("body"))).alias("l"))
    df = df.select("id", "l.chair", "l.ceo", F.array_join("l.board", ",").alias("board"))
    assert steps(df.where("id > 0")).count("from_json") == 1
    assert sorted(map(tuple, df.collect())) == [(1, "A B", None, "U"), (2, None, None, "")]


def test_notices_shuffle_no_page(spark):
    row = "<tr><td>{}</td><td> </td><td><b>{}</b></td></tr>"
    body = "<tr><td>no date</td></tr>" + "".join(row.format(*x) for x in [("02.01.2024", "Fusion"), ("02.01.2024", "Fusion"), ("01.01.2024", "ab"), ("03.01.2024", "see Brreg"), ("04.01.2024", "")] + [(f"0{i}.02.2024", "Change") for i in range(1, 7)])
    rows = spark.createDataFrame([("1", "N", 200, body), ("1", "N", 200, body), ("1", "N", 200, body + " "), ("2", "M", 404, body), ("3", "K", 200, None)], "organisation_number string, name string, status int, body string")
    out = S.notices(rows)
    assert not any("hashpartitioning" in x and "body#" in x for x in steps(out).split("\n"))
    want = ["2024-01-02", "2024-02-01", "2024-02-02", "2024-02-03", "2024-02-04"]
    assert sorted((r.organisation_number, r.published_at) for r in out.collect()) == sorted(("1", d) for d in want * 2)


def test_ladder_has_tasks_enough(spark):
    rows = spark.createDataFrame([("Fjell AS", "912345678", "https://x.no", "Hjem", "", "")], "name string, organisation_number string, url string, title string, text string, declared_host string").coalesce(1)
    assert I.website_ladder(rows).rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
