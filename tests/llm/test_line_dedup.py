from helpers import docs
from loanlens.llm.line_dedup import drop_boilerplate


def test_site_relative_frequency(spark):
    rows = [(i, f"Header line of site\n\n  page {i} has this content, which is its own\nFooter {i % 2}", "en", "a") for i in range(20)]
    rows += [(100 + i, f"Header line of site\nother {i}", "en", "b" if i else "c") for i in range(3)]
    rows += [(200 + i, "a copied page\nas a whole", "en", None) for i in range(10)]
    rows += [(300, None, None, "a"), (301, "", None, "a"), (20, rows[0][1], "en", "a"), (302, "x\n" * 30_000, None, "a")]
    df = docs(spark, rows).withColumnRenamed("n_chars", "n_lines")
    got = {r["doc_id"]: r for r in drop_boilerplate(df, max_ratio=0.3).collect()}
    assert len(got) == len(rows)
    assert got[4]["text"] == "\n  page 4 has this content, which is its own"          # both footers are on 40 % of the pages
    assert (got[4]["n_lines"], got[4]["n_dropped"]) == (4, 2)
    assert got[101]["text"] == rows[21][1]                              # three pages are too few to tell
    assert got[205]["text"] == "" and got[205]["n_dropped"] == 2          # every page of the null host holds these lines
    assert got[300]["text"] is None and got[300]["n_lines"] == 0 and got[300]["n_dropped"] == 0
    assert got[301]["text"] == "" and got[302]["n_dropped"] == 0


def test_empty_table(spark):
    assert drop_boilerplate(docs(spark, [], parts=1)).count() == 0


def test_lists_by_broadcast_and_by_cut_hosts(spark):
    rows = [(i, f"Header of hot\nown line {i}\nsecond own {i}", "en", "hot") for i in range(400)]
    rows += [(1000 + i, f"Header of {i % 20}\nown line {i}", "en", f"h{i % 20}" if i % 20 else None) for i in range(200)]
    rows += [(5, rows[5][1], "en", "hot")] * 10 + [(None, None, None, "hot"), (3000, "Header of hot\n" + "x y\n" * 20_000, "en", "hot")]
    df = docs(spark, rows).withColumnRenamed("lang", "host").withColumnRenamed("n_chars", "keys")
    got = [sorted(map(str, drop_boilerplate(df, max_broadcast=m).collect())) for m in (10_000, 0)]
    assert got[0] == got[1] and len(got[0]) == len(rows)
    done = drop_boilerplate(df, max_broadcast=0)
    assert done.columns == [*df.columns, "n_lines", "n_dropped"]
    assert {r["n_dropped"] for r in done.collect()} == {0, 1} and done.filter("n_dropped = 0").count() == 1
