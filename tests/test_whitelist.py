"""Dictionaries of entries that are repeated very often."""

from cellstrand.operators import whitelist


def test_repeats_are_counted_before_they_are_spread(spark, monkeypatch):
    entries = spark.range(3_000).selectExpr("element_at(array('AAAA', 'CCCC', cast(null AS string)), cast(id % 3 AS int) + 1) AS s").unionByName(spark.createDataFrame([("AAAC",), ("GGGG",), ("",)], "s string"))
    made, given = [], whitelist.variants

    def counting(*args):
        made.append(given(*args))
        return made[-1]

    monkeypatch.setattr(whitelist, "variants", counting)
    found = {(r.variant, r.original) for r in whitelist.correction_dictionary(entries, "s").collect()}
    # 17 of each of the four entries that have bases
    assert made[0].count() == 4 * 17
    assert {o for _, o in found} == {"AAAC", "GGGG"}
    # of AAAC's, AAAA and its five last letters are also reached by AAAA
    assert len([v for v, o in found if o == "AAAC"]) == 17 - 5 and len([v for v, o in found if o == "GGGG"]) == 17
    once = {(r.variant, r.original) for r in whitelist.correction_dictionary(entries, "s", dedup=True).collect()}
    assert {o for _, o in once} == {"AAAA", "CCCC", "AAAC", "GGGG"} and len(once) == 4 * 17 - 2 * 5
