"""The command line over MovieLens-shaped CSV files."""

import glob
import os
import tempfile

from ratekit.cli import main

MOVIES = (
    "movieId,title,genres\n"
    "1,Alpha,Animation|Romance\n"
    "2,Beta,Animation\n"
    '3,"Gamma, The",Documentary|Animation\n'
    "4,Delta,(no genres listed)\n"
    "5,Beta,Romance\n"
)
RATINGS = "userId,movieId,rating,timestamp\n" + "".join(
    f"{u},{i},{r},0\n"
    for u, i, r in [
        (1, 1, 5.0), (2, 1, 4.0), (3, 1, 3.0), (1, 2, 4.0), (2, 2, 4.0),
        (1, 3, 2.0), (2, 3, 2.0), (3, 4, 5.0),
    ]
)


def _files():
    d = tempfile.mkdtemp(prefix="ratekit-cli-")
    for name, text in (("movies.csv", MOVIES), ("ratings.csv", RATINGS)):
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    return d


def test_values_command_writes_report(spark, capsys):
    d = _files()
    out = os.path.join(d, "report")
    rc = main(["values", "--items", f"{d}/movies.csv", "--ratings", f"{d}/ratings.csv",
               "--values", "Animation,Romance,Documentary", "--min-count", "1", "--report", out])
    assert rc == 0
    text = "".join(open(p).read() for p in sorted(glob.glob(out + "/part-*")))
    assert "## Animation: top 10 by number of ratings" in text
    assert "| Alpha | 3 | 4.000 |" in text
    assert "| Gamma, The | 2 | 2.000 |" in text
    assert "| (no genres listed) | 1 |" in text


def test_cf_command_prints_metrics(spark, capsys):
    d = _files()
    rc = main(["cf", "--ratings", f"{d}/ratings.csv", "--model", "centered", "--min-common", "1"])
    assert rc == 0
    out = capsys.readouterr().out
    assert "Mean rating in train:" in out and "Fallback predictions:" in out
