from lanecost.operators.splits import split_negative, split_nontransparent


def test_negative_margin_flagged_zero_and_null_clean(spark):
    df = spark.createDataFrame([("a", -1.5), ("b", 0.0), ("c", None), ("d", 2.0)],
                               "firm string, `fx margin` double")
    clean, flagged = split_negative(df)
    assert [r["firm"] for r in flagged.collect()] == ["a"]
    assert sorted(r["firm"] for r in clean.collect()) == ["b", "c", "d"]


def test_transparency_flags_no_any_case_and_padding(spark):
    df = spark.createDataFrame([("a", "no"), ("b", "No"), ("c", " NO "), ("d", "Yes"), ("e", " YES "),
                                ("f", None)], "firm string, transparent string")
    clean, flagged = split_nontransparent(df)
    assert sorted(r["firm"] for r in flagged.collect()) == ["a", "b", "c"]
    assert sorted(r["firm"] for r in clean.collect()) == ["d", "e", "f"]
    assert clean.columns == df.columns
