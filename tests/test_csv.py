"""CSV quoting (FIXTURES section 3) and a distributed write/read round trip."""

import os
import tempfile

import pytest

from ratekit.sources import read_items_csv, read_ratings_csv, rejected_ratings_csv, write_csv

ITEMS_CSV = (
    "movieId,title,genres\n"
    "1,Toy Story (1995),Adventure|Animation|Children\n"
    '2,"""Sr."" (2022)",Documentary\n'
    '3,"Lion King, The (1994)",Animation|Romance\n'
    '4,"Say ""Hi"", Again (2000)",(no genres listed)\n'
)


def _write(text):
    d = tempfile.mkdtemp(prefix="ratekit-csv-")
    p = os.path.join(d, "items.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_quoted_titles(spark):
    df = read_items_csv(spark, _write(ITEMS_CSV))
    got = {r.item_id: (r.title, r.tags) for r in df.collect()}
    assert got[1] == ("Toy Story (1995)", "Adventure|Animation|Children")
    assert got[2] == ('"Sr." (2022)', "Documentary")
    assert got[3] == ("Lion King, The (1994)", "Animation|Romance")
    assert got[4] == ('Say "Hi", Again (2000)', "(no genres listed)")


def test_ratings_reader_prunes_and_types(spark):
    p = _write("userId,movieId,rating,timestamp\n1,10,4.5,964982703\n2,10,0.5,964982704\n")
    df = read_ratings_csv(spark, p)
    assert df.columns == ["user_id", "item_id", "rating"]
    assert sorted(tuple(r) for r in df.collect()) == [(1, 10, 4.5), (2, 10, 0.5)]


def test_round_trip(spark):
    src = read_items_csv(spark, _write(ITEMS_CSV))
    out = tempfile.mkdtemp(prefix="ratekit-csv-out-") + "/items"
    write_csv(src.repartition(2), out)
    back = read_items_csv(spark, out)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in src.collect())


def test_round_trip_keeps_every_text(spark):
    rows = [
        (1, "  both ends  ", "a|b"), (2, 'line\nbreak, "q"', ""), (3, None, None), (4, "", "x"),
        (5, '"Sr." (2022)', "\\N"), (6, "back\\slash", " "), (7, "cr\rlf\r\n", "t"),
    ]
    out = tempfile.mkdtemp(prefix="ratekit-csv-out-") + "/items"
    write_csv(spark.createDataFrame(rows, "item_id long, title string, tags string").repartition(3), out)
    assert sorted(map(tuple, read_items_csv(spark, out).collect())) == rows


def test_columns_are_found_by_name_and_bad_rows_kept(spark):
    p = _write("movieId,timestamp,userId,rating\n10,9,1,4.5\nx,9,1,3\n11,9,,3\n12,9,2,bad\n13,9,3,0.5\n")
    assert sorted(map(tuple, read_ratings_csv(spark, p).collect())) == [(1, 10, 4.5), (3, 13, 0.5)]
    bad = sorted(tuple(str(x) for x in r) for r in rejected_ratings_csv(spark, p).collect())
    assert bad == [("1", "x", "3"), ("2", "12", "bad"), ("None", "11", "3")]
    with pytest.raises(ValueError, match="title"):
        read_items_csv(spark, p)


def test_line_breaks_inside_quotes_are_found(spark):
    import os
    import tempfile

    from ratekit.sources import has_line_breaks, read_items_csv

    d = tempfile.mkdtemp(prefix="ratekit-csv-")
    head = "movieId,title,genres\n"
    for name, text, broken in (("plain", '1,"A ""b"", c",X\n2,D,Y\n', False), ("broken", '1,"A\nB",X\n2,D,Y\n', True)):
        path = os.path.join(d, f"{name}.csv")
        with open(path, "w") as f:
            f.write(head + text)
        assert has_line_breaks(spark, path) is broken
        assert [r["tags"] for r in read_items_csv(spark, path).orderBy("item_id").collect()] == ["X", "Y"]
