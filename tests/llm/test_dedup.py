"""One row stays for each component, whatever its ids are."""

from chronolens.llm import simhash


def test_null_and_repeated_ids_do_not_join_components(spark):
    apart = [f"{w} stands alone with {w} and its own {w} words number {i}" for i, w in enumerate(["river", "house", "cloud", "stone", "forest", "engine"])]
    rows = [(None, t) for t in apart[:3]] + [(None, apart[0]), (7, apart[3]), (7, apart[4]), (7, apart[4]), (9, apart[4]), (None, apart[5]), (8, apart[5])]
    kept = simhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    expected = {*[(None, t) for t in apart[:3]], (7, apart[3]), (7, apart[4]), (8, apart[5])}
    got = [tuple(r) for r in kept.collect()]
    assert len(got) == len(expected) and set(got) == expected
