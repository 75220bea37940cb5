from tests.test_orphans import found, parents, refs


def test_na_as_an_accession_is_reported_where_only_donors_refer_to_nothing(spark):
    r, p = refs(spark, [("NA", 1), (None, 1), ("", 1)]), parents(spark, [("A", 0, None)])
    assert found(r, p, nothing=()) == [(0, "missing"), (2, "missing")] and found(r, p) == []


def test_a_null_begin_does_not_join_later_spans(spark):
    p = parents(spark, [("A", None, None), ("A", 0, 10), ("A", 20, None)])
    assert found(refs(spark, [("A", 5), ("A", 15), ("A", 25)]), p) == [(1, "deleted")]
