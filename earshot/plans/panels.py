"""The analyses that belong together, as lazy frames by name.

A panel starts from one selection of plays. Persist the plays first when several of
its frames will be computed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame

from earshot.operators import blend, compat, stats, wrapped
from earshot.operators.filters import all_plays_in_range, plays_by_months, user_plays
from earshot.operators.prepare import apply_cutoff, apply_floor


def user_panel(
    plays: DataFrame, user: str, start: date | str, end: date | str
) -> dict[str, DataFrame]:
    """One user's listening on the days strictly between `start` and `end`."""
    own = user_plays(plays, user, start, end)
    features = stats.top_track_features(own)
    return {
        "top_tracks": stats.top_tracks(own),
        "hourly_share": stats.hourly_share(own),
        "weekday_share": stats.weekday_share(own),
        "daily_unique_artists": stats.daily_unique_artists(own),
        "favourite_artist": stats.favourite_artist(own),
        "artist_tempo_range": stats.artist_tempo_range(own, plays),
        "artist_tempo_density": stats.artist_tempo_density(own, plays),
        "radar": stats.radar_frame(features),
    }


def blend_panel(
    plays: DataFrame,
    users: Sequence[str],
    start: date | str,
    end: date | str,
    cutoffs: Mapping[str, date | str] | None = None,
    floors: Mapping[str, date | str] | None = None,
) -> dict[str, DataFrame]:
    """Users compared; cutoffs hold everywhere, floors for the running total only.

    `rankings` has all five measures of a user from one pass; the frames of their names
    rank users by one of them."""
    ranged = all_plays_in_range(apply_cutoff(plays, cutoffs or {}), start, end)
    rankings = {name: blend.rank(ranged, name) for name in blend.RANKINGS}
    return {
        "rankings": blend.rankings(ranged),
        **rankings,
        "mutual_artist": blend.mutual_artist(ranged, users),
        "mutual_track": blend.mutual_track(ranged, users),
        "cumulative_minutes": blend.cumulative_minutes(apply_floor(ranged, floors or {})),
    }


def wrapped_panel(
    plays: DataFrame,
    songs: DataFrame,
    calendar: DataFrame,
    person: str,
    year: int,
    first: int = 1,
    last: int = 12,
    feature: str = "valence",
    artist: str | None = None,
) -> dict[str, DataFrame]:
    """A person's year, or the months `first` to `last` of it."""
    own = plays_by_months(plays, person, year, first, last)
    own_songs = songs.filter(songs.person == person)
    return {
        "weekday_average": wrapped.weekday_average_minutes(own, calendar, year, first, last),
        "hourly_average": wrapped.hourly_average_minutes(own, calendar, year, first, last),
        "top_artists": wrapped.top_artists(own),
        "artist_tracks": wrapped.artist_track_play_equivalents(own, songs, artist),
        "artist_radar": wrapped.artist_radar(own, own_songs, artist),
        "top_tracks": wrapped.top_track_counts(own),
        "feature_distribution": wrapped.feature_distribution(songs, person, feature),
    }


def compatibility_panel(
    plays: DataFrame, profile: DataFrame, left: str, right: str
) -> dict[str, DataFrame]:
    """Two persons compared over their whole history."""
    return {
        "profile": compat.compatibility_profile(profile, left, right),
        "score": compat.compatibility_score(plays, left, right),
        "artists": compat.compatibility_artists(plays, left, right),
    }
