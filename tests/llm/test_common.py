from helpers import docs, prose
from pyspark.sql import functions as F

from loanlens.llm.common import even_sample, one_in


def test_one_in():
    assert one_in({"a": 10, "b": 20}, 100) == {"a": 1, "b": 1}
    assert one_in({"rare": 3, "few": 40, "c": 9957}, 300) == {"rare": 1, "few": 4, "c": 34}
    assert one_in({}, 5) == {} and set(one_in({i: 10 for i in range(50)}, 5).values()) == {10}


def test_rare_labels_and_copies_have_their_share(spark):
    rows = [(i, prose(i, 12), "big") for i in range(3000)] + [(i, "the same text", "big") for i in range(1500)]
    rows += [(i, prose(9000 + i, 12), "rare") for i in range(7)] + [(1, "", "rare"), (2, "x", None)]
    for parts in (1, 5):
        got = even_sample(docs(spark, rows, parts=parts), "text", "lang", 300, "test")
        by = {r["lang"]: r["n"] for r in got.groupBy("lang").agg(F.sum("copies").alias("n")).collect()}
        assert by["rare"] == 8 and None not in by and 200 < by["big"] < 400
        same = got.filter("text = 'the same text'").first()["copies"]
        assert abs(same - by["big"] / 3) < 30
    whole = even_sample(docs(spark, rows), "text", "lang", 10_000, "test")
    assert whole.agg(F.sum("copies")).first()[0] == len(rows) - 1
    assert even_sample(docs(spark, [], parts=1), "text", "lang", 10, "test").count() == 0
