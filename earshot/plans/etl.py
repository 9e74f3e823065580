"""The preparation job: from raw exports and lookups to the curated plays table.

All frames are lazy. How the small side of a join travels is left to Spark: it is
broadcast once its measured size is under the session's threshold, and shuffled otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions import file_order, first_per_key
from earshot.operators import prepare
from earshot.schema import ARTIST_ATTRIBUTES, TRACK_FEATURES
from earshot.sources import read_exports, read_plays, write_plays

PAIR = ["track_name", "artist_name"]


def with_track_features(plays: DataFrame, track_features: DataFrame) -> DataFrame:
    """Plays with the features of their track's first row."""
    return prepare.attach_track_features(plays, prepare.track_dim(plays, track_features))


def with_artist_attributes(
    plays: DataFrame, track_artists: DataFrame, artist_profiles: DataFrame
) -> DataFrame:
    """Plays with the attributes of the artist of their artist's first track."""
    dim = prepare.artist_dim(plays, track_artists, artist_profiles)
    return prepare.attach_artist_attributes(plays, dim)


def pair_dim(
    plays: DataFrame,
    track_features: DataFrame,
    track_artists: DataFrame,
    artist_profiles: DataFrame,
) -> DataFrame:
    """Features and artist attributes per pair of track and artist name.

    The first row of a track or artist is the first of one of its pairs, so one pass
    over the plays serves both dimensions, which are then attached to the pairs.
    """
    order = file_order(plays)
    pairs = first_per_key(plays.select(*PAIR, "spotify_track_uri", *order), PAIR, order)
    featured = prepare.attach_track_features(
        pairs.select(*PAIR), prepare.track_dim(pairs, track_features)
    )
    return prepare.attach_artist_attributes(
        featured, prepare.artist_dim(pairs, track_artists, artist_profiles)
    )


def curated_plays(
    raw: DataFrame,
    track_features: DataFrame,
    track_artists: DataFrame,
    artist_profiles: DataFrame,
    username: str | None = None,
    cutoffs: Mapping[str, date | str] | None = None,
) -> DataFrame:
    """A raw export, normalised, enriched and cut off, ready for `write_plays`.

    The plays are joined once, with the pairs of both names, which is one shuffle of
    them on a key finer than either name.
    """
    plays = prepare.normalise_export(raw, username)
    pairs = pair_dim(plays, track_features, track_artists, artist_profiles)
    right = pairs.select(
        *[F.col(name).alias(f"_{name}") for name in PAIR], *TRACK_FEATURES, *ARTIST_ATTRIBUTES
    )
    same = [plays[name].eqNullSafe(right[f"_{name}"]) for name in PAIR]
    joined = plays.join(right, same, "left").drop(*[f"_{name}" for name in PAIR])
    return prepare.apply_cutoff(joined, cutoffs or {})


def store_plays(
    spark: SparkSession,
    exports: Mapping[str, str],
    lookups: Mapping[str, str],
    path: str,
    cutoffs: Mapping[str, date | str] | None = None,
) -> DataFrame:
    """The whole job: several users' export files to stored plays at `path`, read back.

    `exports` has each user's file or folder of JSON records. `lookups` has the paths
    of the Parquet tables `track_features`, `track_artists` and `artist_profiles`.
    Nothing else is written, and the stored plays are the caller's to delete.
    """
    tables = {name: spark.read.parquet(place) for name, place in lookups.items()}
    plays = curated_plays(read_exports(spark, exports), **tables, cutoffs=cutoffs)
    write_plays(plays, path)
    return read_plays(spark, path)
