import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from earshot.schema import PLAYS  # noqa: E402
from earshot.session import session  # noqa: E402

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        app="tests",
        master="local[8]",
        shuffle_partitions=8,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__maxMetadataStringLength="2000",
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture
def make_plays(spark):
    """A plays table from partial rows; what a row leaves out gets a plain value."""

    def build(*rows):
        complete = []
        for row in rows:
            time = row.get("time", "2024-03-05 10:00:00")
            play = dict.fromkeys(PLAYS.fieldNames())
            play |= {
                "username": "ann",
                "ms_played": 60000,
                "track_name": "song",
                "artist_name": "artist",
                "album_name": "album",
                "genre": "genre",
                "image": "image",
                "followers": 10,
            }
            play |= row
            play["time"] = datetime.fromisoformat(time)
            play["hour"] = play["time"].hour
            complete.append(tuple(play[name] for name in PLAYS.fieldNames()))
        return spark.createDataFrame(complete, PLAYS)

    return build


@pytest.fixture
def rows():
    """All rows of a frame as plain tuples."""
    return lambda df: [tuple(row) for row in df.collect()]
