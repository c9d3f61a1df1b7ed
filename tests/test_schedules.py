"""The registered schedule that asks for more questions than there are stems."""

import __spark_entry__


def test_schedule_extended(spark, small_dir):
    queries = __spark_entry__.queries()
    stems = [r["pair_id"] for r in queries["eligible_pairs"](spark, small_dir).collect()]
    rows = queries["schedule_extended"](spark, small_dir).collect()
    assert len(rows) == len(stems) * 3 // 2 > len(stems)
    assert sorted(r["stem_id"] for r in rows if r["copy"] == 0) == sorted(stems)
    assert {r["stem_id"] for r in rows} == set(stems) and len({(r["stem_id"], r["copy"]) for r in rows}) == len(rows)
