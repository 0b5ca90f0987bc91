"""Order of lines, margins and checked unions."""

import pytest

from logloom.operators import joins, windows
from logloom.sources import readers


def test_first_lines_of_every_file(spark, tmp_path):
    for name, rows in (("a", ["z", "y", "", "x"]), ("b", ["3", "1", "2"])):
        (tmp_path / f"{name}.txt").write_text("\n".join(rows))
    got = readers.first_per_file(readers.lines(spark, str(tmp_path)), 2).select("line").collect()
    assert sorted(r["line"] for r in got) == ["1", "3", "y", "z"]


def test_a_group_of_one_is_an_error(spark):
    df = spark.createDataFrame([(1, 2.0, 1), (1, 5.0, 2), (2, 1.0, 3)], "g int, r double, i int")
    good = windows.best_margin(df.filter("g = 1"), "g", "r", "i").collect()
    assert sorted((r["i"], r["pass_k"]) for r in good) == [(1, 0.0), (2, 3.0)]
    with pytest.raises(Exception, match="group of one"):
        windows.best_margin(df, "g", "r", "i").collect()


def test_a_checked_union_needs_both_sides(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, s string")
    b = spark.createDataFrame([(1, "x", 5), (2, "y", 6)], "k int, s string, n int")
    assert sorted(map(tuple, joins.union_checked(a, b, "k").collect())) == [(1, "x", 5), (2, "y", 6)]
    for wrong in (b.filter("k = 1"), b.replace("y", "q")):
        with pytest.raises(Exception, match="one side only|column s differs"):
            joins.union_checked(a, wrong, "k").collect()
