"""Substring search by postings, against the scan."""

import pytest

from marketflow.operators.search import find, needed, pieces, postings
from marketflow.plans import markets as plans
from marketflow.sources import snapshots, tables
from tests.conftest import rows

QUESTIONS = ["Will Bitcoin hit 100k?", "will BITCOIN fall", "Bit coin", "100% sure_thing", "1000 sure thing", "İstanbul vs. Ankara", "Élan vital", "élan", "ab", "", None, "aaaa", "a\\b%c", "naïve bitumen"]
PATTERNS = ["bitcoin", "BIT", "bi", "", "it%in", "b_tco", "100%", "100\\%", "sure_thing", "sure\\_thing", "istanbul", "İst", "élan", "ÉLAN", "aaaa", "aaaaa", "l v", "a\\\\b", "%", "___", "naïve", "vs. a", "zzz", "it co", "will%fall", "thing%sure"]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, f"m{i}", q) for i, q in enumerate(QUESTIONS)], "id long, market_id string, question string").cache()


@pytest.fixture(scope="module")
def index(texts):
    return postings(texts, ["id", "market_id"], "question").cache()


@pytest.mark.parametrize("text", PATTERNS)
def test_equals_the_scan(spark, texts, index, text):
    want = rows(texts.filter(texts.question.ilike(f"%{text}%")), "id")
    assert rows(find(texts, index, ["id", "market_id"], "question", text), "id") == want


def test_what_a_pattern_needs():
    assert pieces("ab%c_d\\%e\\\\") == ["ab", "c", "d%e\\"]
    assert needed("ab%cd") == [] and needed("BITco") == ["bit", "itc", "tco"] and needed("xéabc") == ["abc"]


def test_postings(spark, texts, index):
    assert index.filter("id IN (8, 9, 10)").count() == 0 and rows(index.filter("id = 11"), "gram") == [("aaa",)]
    assert index.groupBy("gram", "id").count().filter("count > 1").count() == 0


def test_only_candidates_are_compared(spark, tables_of_many):
    """The intersection of the lists leaves few rows for the comparison."""
    many = tables_of_many
    lists = postings(many, ["id"], "question").filter("gram IN ('777', '77x', '7x ')").groupBy("id").count().filter("count = 3")
    assert lists.count() == many.filter("question LIKE '%777x %'").count() == rows(find(many, postings(many, ["id"], "question"), ["id"], "question", "777x ")).__len__()


@pytest.fixture(scope="module")
def tables_of_many(spark):
    return spark.range(5000).selectExpr("id", "concat('number ', id, 'x of many') AS question").cache()


def test_search_in_the_snapshot(spark, tmp_path):
    root, schema = str(tmp_path), "market_id string, condition_id string, question string"
    assert snapshots.search(spark, root, "x") is None
    tables.write_markets(spark.createDataFrame([("m1", "c1", "Rain on Monday"), ("m2", "c2", "Snow")], schema), root, now="2024-01-01 00:00:00", batch_id=0)
    assert rows(snapshots.search(spark, root, "rain"), "market_id") == [("m1",)]
    tables.write_markets(spark.createDataFrame([("m1", "c1", "Sun on Monday"), ("m3", "c3", "Acid rain")], schema), root, now="2024-01-02 00:00:00", batch_id=1)
    assert rows(snapshots.search(spark, root, "rain"), "market_id") == [("m3",)]
    assert rows(snapshots.search(spark, root, "MON_AY"), "market_id") == [("m1",)]


def test_limits_of_a_search_are_checked(spark, texts):
    with pytest.raises(ValueError):
        plans.search_markets(texts, texts, texts, "x", limit=10**6)
