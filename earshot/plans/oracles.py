"""The catalog's queries as SQL over the same tables, for DuckDB."""

from __future__ import annotations

from earshot.schema import RADAR_FEATURES, TRACK_FEATURES

_START, _END = "DATE '2024-01-01'", "DATE '2024-12-31'"
_RADAR = ", ".join(RADAR_FEATURES)
_ALL_FEATURES = ", ".join(TRACK_FEATURES)

_CATALOGUE = """
catalogue AS (
  SELECT p_partkey, p_name AS track_name,
    CASE WHEN p_partkey % 23 <> 0 THEN p_brand END AS artist_name,
    'album ' || p_size AS album_name,
    CASE WHEN p_partkey % 23 <> 0 AND b % 8 <> 0 THEN 'genre ' || (b % 6) END AS genre,
    CASE WHEN p_partkey % 23 <> 0 AND b % 9 <> 0 THEN 'img/' || b END AS image,
    CASE WHEN p_partkey % 23 <> 0 AND b % 5 <> 0 THEN b * 1371 END AS followers,
    CAST(p_partkey * 13 % 1000 AS DOUBLE) / 1000 AS danceability,
    CASE WHEN p_partkey % 31 <> 0 THEN CAST(p_partkey * 17 % 1000 AS DOUBLE) / 1000 END AS energy,
    CAST(p_partkey % 12 AS INTEGER) AS key,
    CAST(-(p_partkey % 60) AS DOUBLE) AS loudness,
    CAST(p_partkey % 2 AS INTEGER) AS mode,
    CAST(p_partkey * 19 % 1000 AS DOUBLE) / 1000 AS speechiness,
    CAST(p_partkey * 29 % 1000 AS DOUBLE) / 1000 AS acousticness,
    CAST(p_partkey * 31 % 1000 AS DOUBLE) / 1000 AS instrumentalness,
    CAST(p_partkey * 41 % 1000 AS DOUBLE) / 1000 AS liveness,
    CAST(p_partkey * 43 % 1000 AS DOUBLE) / 1000 AS valence,
    CASE WHEN p_partkey % 29 <> 0
      THEN CAST(600 + p_partkey * 37 % 1200 AS DOUBLE) / 10 END AS tempo,
    'spotify:track:' || p_partkey AS spotify_track_uri,
    CASE WHEN p_partkey % 37 <> 0 THEN 120000 + p_partkey * 700 END AS duration_ms,
    p_brand
  FROM (SELECT *, CAST(substr(p_brand, 7) AS BIGINT) AS b FROM part)
)"""

_PLAYS = (
    _CATALOGUE
    + """,
listening AS (
  SELECT event_id, ts + to_days(CAST(event_id % 330 AS INTEGER)) AS time,
    CASE user_id % 3 WHEN 0 THEN 'user_a' WHEN 1 THEN 'user_b' ELSE 'user_c' END AS username,
    CAST(round(value * 1000) AS BIGINT) AS ms_played,
    (CAST(json_extract(props, '$.k') AS BIGINT) * CAST(json_extract(props, '$.k') AS BIGINT))
      // (50 + 200 * (user_id % 3)) AS track_key
  FROM events
),
plays AS (
  SELECT l.event_id, l.time, l.username, l.ms_played,
    c.* EXCLUDE (p_partkey, p_brand), CAST(hour(l.time) AS INTEGER) AS hour
  FROM listening l JOIN catalogue c ON c.p_partkey = l.track_key
)"""
)

_RANGE = (
    _PLAYS
    + f""",
ranged AS (
  SELECT * FROM plays WHERE CAST(time AS DATE) > {_START} AND CAST(time AS DATE) < {_END}
)"""
)

_OWN = _RANGE + ", own AS (SELECT * FROM ranged WHERE username = 'user_a')"

_YEAR = (
    _PLAYS
    + """,
mine AS (
  SELECT * FROM plays
  WHERE username = 'user_a' AND year(time) = 2024 AND month(time) BETWEEN 1 AND 12
)"""
)

_NORMALISED = (
    _PLAYS
    + """,
normalised AS (
  SELECT event_id, username, date_trunc('second', time) AS time, ms_played, track_name,
    album_name, artist_name, spotify_track_uri, hour
  FROM plays
)"""
)

_TRACK_DIM = (
    _NORMALISED
    + f""",
track_dim AS (
  SELECT f.track_name, {_ALL_FEATURES}
  FROM (
    SELECT track_name, spotify_track_uri FROM normalised
    QUALIFY row_number() OVER (PARTITION BY track_name ORDER BY time, event_id) = 1
  ) f
  LEFT JOIN (SELECT spotify_track_uri, {_ALL_FEATURES} FROM catalogue) c
    ON c.spotify_track_uri = f.spotify_track_uri
)"""
)

_PROFILES = """
profiles AS (
  SELECT DISTINCT p_brand AS artist_id,
    CASE WHEN b % 8 <> 0 THEN 'genre ' || (b % 6) END AS genre,
    CASE WHEN b % 9 <> 0 THEN 'img/' || b END AS image,
    CASE WHEN b % 5 <> 0 THEN b * 1371 END AS followers
  FROM (SELECT p_brand, CAST(substr(p_brand, 7) AS BIGINT) AS b FROM part)
)"""

_ARTIST_PART = (
    ","
    + _PROFILES
    + """,
artist_dim AS (
  SELECT f.artist_name, p.image, p.genre, p.followers
  FROM (
    SELECT artist_name, spotify_track_uri FROM normalised WHERE artist_name IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY artist_name ORDER BY time, event_id) = 1
  ) f
  LEFT JOIN catalogue c ON c.spotify_track_uri = f.spotify_track_uri
  LEFT JOIN profiles p ON p.artist_id = c.p_brand
)"""
)

_ARTIST_DIM = _NORMALISED + _ARTIST_PART

_SONGS = """,
songs AS (
  SELECT username AS person, track_name, artist_name, duration_ms, {features},
    min(time) AS time
  FROM plays WHERE duration_ms IS NOT NULL GROUP BY ALL
)""".format(features=_ALL_FEATURES)

_MINUTES = "CAST(sum(ms_played) AS BIGINT) / CAST(60000 AS DOUBLE)"
_WHOLE_MINUTES = f"round_even({_MINUTES}, 0)"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def _favourite(source: str, keys: str, total: str, order: str) -> str:
    complete = " AND ".join(f"{key.strip()} IS NOT NULL" for key in keys.split(","))
    return f"""
SELECT {keys}, {total} AS minutes_listened, count(*) AS songs_played
FROM {source} WHERE {complete} GROUP BY {keys}
ORDER BY {order} DESC, {keys} LIMIT 1"""


_ARTIST_KEYS = "artist_name, image, genre, followers"
_FAVOURITE = _favourite("own", _ARTIST_KEYS, _WHOLE_MINUTES, "minutes_listened")


def _density(values: str) -> str:
    """Density query over a frame `values` with one column `v`."""
    return f"""
, vals AS ({values}),
stats AS (
  SELECT min(v) AS lo, max(v) AS hi, count(*) AS total, stddev_samp(v) AS sd,
    (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) / CAST(1.34 AS DOUBLE) AS iqr
  FROM vals HAVING count(*) > 1
),
width AS (
  SELECT lo, hi, total, CAST(0.9 AS DOUBLE) * coalesce(nullif(least(sd, iqr), 0),
    nullif(sd, 0), nullif(abs(lo), 0), 1) * pow(total, CAST(-0.2 AS DOUBLE)) AS h
  FROM stats
),
counted AS (SELECT v, count(*) AS n FROM vals GROUP BY v),
grid AS (
  SELECT CAST(i AS INTEGER) AS point, lo + i * (hi - lo) / CAST(511 AS DOUBLE) AS x, h, total
  FROM width, range(512) r(i)
)
SELECT point, round(x, 6) AS x,
  round(sum(n * exp(-0.5 * pow((x - v) / h, 2))) / (sqrt(2 * pi()) * total * h), 6) AS density
FROM grid, counted GROUP BY point, x, h, total ORDER BY point"""


def _share(key: str, name: str) -> str:
    return f"""
SELECT {name}, ms / CAST(60000 AS DOUBLE) AS minutes_listened,
  all_ms / CAST(60000 AS DOUBLE) AS total_time,
  CAST(ms AS DOUBLE) / all_ms * 100 AS repartition
FROM (
  SELECT *, CAST(sum(ms) OVER () AS BIGINT) AS all_ms
  FROM (SELECT {key} AS {name}, CAST(sum(ms_played) AS BIGINT) AS ms FROM own GROUP BY 1)
) ORDER BY {name}"""


def _means(source: str, tail: str = "") -> str:
    means = ", ".join(f"round(avg({f}), 6) AS {f}" for f in RADAR_FEATURES)
    return f"SELECT {means} FROM {source} {tail}"


_TOP_NAMES = """
SELECT track_name, count(*) AS songs_played FROM own WHERE track_name IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""

_FIRST_OF_TOP = f""",
first_of_top AS (
  SELECT * FROM (
    SELECT * FROM own
    QUALIFY row_number() OVER (PARTITION BY track_name ORDER BY time, event_id) = 1
  ) WHERE track_name IN (SELECT track_name FROM ({_TOP_NAMES}))
)"""


def _radar_rows(source: str) -> str:
    ones = ", ".join(f"CAST(1 AS DOUBLE) AS {f}" for f in RADAR_FEATURES)
    zeros = ", ".join(f"CAST(0 AS DOUBLE) AS {f}" for f in RADAR_FEATURES)
    # Like the query, no value row means no frame.
    return f"""
SELECT 1 AS position, 'max' AS kind, {ones} FROM {source}
UNION ALL SELECT 2, 'min', {zeros} FROM {source}
UNION ALL SELECT 3, 'value', {_RADAR} FROM {source}"""


_PLAYLIST = f""",
playlist AS (
  SELECT username AS who, artist_name, track_name, count(*) AS count, {_MINUTES} AS time,
    min(image) AS image
  FROM plays WHERE artist_name IS NOT NULL AND track_name IS NOT NULL GROUP BY ALL
)"""

_USERS = ("user_a", "user_b", "user_c")


def _mutual(keys: str, threshold: int) -> str:
    counts = {f"n_{u}": f"count(*) FILTER (username = '{u}')" for u in _USERS}
    columns = ", ".join(f"{count} AS {name}" for name, count in counts.items())
    having = " AND ".join(f"{count} > {threshold}" for count in counts.values())
    return f"""
SELECT {keys}, {columns}, count(*) AS total FROM ranged
WHERE username IN ('user_a', 'user_b', 'user_c')
GROUP BY {keys} HAVING {having}"""


_TOP_ARTISTS = f"""
SELECT * FROM (
  SELECT artist_name, {_MINUTES} AS time FROM mine GROUP BY 1
  ORDER BY time DESC, artist_name NULLS LAST LIMIT 10
) WHERE artist_name IS NOT NULL"""

_TOP_ARTIST = f"(SELECT artist_name FROM ({_TOP_ARTISTS}) ORDER BY time DESC, artist_name LIMIT 1)"

_DAYS = """,
days AS (
  SELECT CAST(d AS DATE) AS date
  FROM generate_series(DATE '2024-01-01', DATE '2024-12-31', INTERVAL 1 DAY) g(d)
)"""

_ARTIST_MEANS = """
SELECT artist_name, {means} FROM songs
WHERE person = 'user_a' GROUP BY artist_name
HAVING artist_name IS NOT NULL AND {complete}""".format(
    means=", ".join(f"round(avg({f}), 6) AS {f}" for f in RADAR_FEATURES),
    complete=" AND ".join(f"count({f}) = count(*)" for f in RADAR_FEATURES),
)

_COMPLETE = " AND ".join(f"{f} IS NOT NULL" for f in RADAR_FEATURES)


def _shared(n: int) -> str:
    return f""",
best AS (
  SELECT username, artist_name, ms, row_number() OVER (
      PARTITION BY username ORDER BY ms DESC, artist_name) AS place
  FROM (
    SELECT username, artist_name, CAST(sum(ms_played) AS BIGINT) AS ms FROM plays
    WHERE username IN ('user_a', 'user_b') AND artist_name IS NOT NULL GROUP BY ALL
  ) QUALIFY place <= {n}
),
pointed AS (
  SELECT username, artist_name, ms / CAST(60000 AS DOUBLE) AS time,
    CAST(ms AS DOUBLE) / CAST(sum(ms) OVER (PARTITION BY username) AS BIGINT) * 100 AS points
  FROM best
),
shared AS (
  SELECT l.artist_name, l.time AS time_left, l.points AS points_left,
    r.time AS time_right, r.points AS points_right, greatest(l.points, r.points) AS score
  FROM pointed l JOIN pointed r ON r.artist_name = l.artist_name
  WHERE l.username = 'user_a' AND r.username = 'user_b'
)"""


_SCORE = """
SELECT CAST(coalesce(round_even(sum(score), 0), 0) AS BIGINT) AS total_score,
  count(*) AS mutual_artists FROM shared"""

_ROUNDED_PLAYLIST = (
    _PLAYLIST + ",\nrounded AS (SELECT * REPLACE (round(time, 6) AS time) FROM playlist)"
)

ORACLES: dict[str, str] = {
    "union_users": _with(_NORMALISED, "SELECT * FROM normalised"),
    "calendar_days": _with(
        _PLAYS,
        """
SELECT CAST(unnest(generate_series(CAST(min(time) AS DATE), CAST(max(time) AS DATE),
  INTERVAL 1 DAY)) AS DATE) AS date FROM plays""",
    ),
    "normalise_plays": _with(_NORMALISED, "SELECT * FROM normalised"),
    "track_dim": _with(_TRACK_DIM, "SELECT * FROM track_dim"),
    "artist_dim": _with(_ARTIST_DIM, "SELECT * FROM artist_dim"),
    "enrich_track_features": _with(
        _TRACK_DIM,
        f"""
SELECT n.*, {_ALL_FEATURES} FROM normalised n
LEFT JOIN track_dim d ON n.track_name IS NOT DISTINCT FROM d.track_name""",
    ),
    "first_of_list": _with(_PROFILES, "SELECT * FROM profiles"),
    "enrich_artist_attributes": _with(
        _ARTIST_DIM,
        """
SELECT n.*, d.image, d.genre, d.followers FROM normalised n
LEFT JOIN artist_dim d ON n.artist_name = d.artist_name""",
    ),
    "apply_cutoff": _with(
        _PLAYS,
        """
SELECT * FROM plays
WHERE username IS DISTINCT FROM 'user_c' OR time < TIMESTAMP '2024-12-08'""",
    ),
    "curated_plays": _with(
        _TRACK_DIM + _ARTIST_PART,
        f"""
SELECT n.*, {_ALL_FEATURES}, a.image, a.genre, a.followers FROM normalised n
LEFT JOIN track_dim t ON n.track_name IS NOT DISTINCT FROM t.track_name
LEFT JOIN artist_dim a ON n.artist_name = a.artist_name
WHERE username <> 'user_c' OR time < TIMESTAMP '2024-12-08'""",
    ),
    **dict.fromkeys(
        ("personal_playlist", "csv_round_trip", "json_round_trip", "json_array_round_trip"),
        _with(_PLAYS + _PLAYLIST, "SELECT * REPLACE (round(time, 6) AS time) FROM playlist"),
    ),
    "csv_good_rows": _with(_PLAYS + _ROUNDED_PLAYLIST, "SELECT * FROM rounded WHERE count % 5 > 1"),
    "json_good_rows": _with(_PLAYS + _ROUNDED_PLAYLIST, "SELECT * FROM rounded WHERE count % 5 > 1"),
    "csv_broken_rows": _with(
        _PLAYS + _ROUNDED_PLAYLIST,
        """
SELECT who, coalesce(artist_name, 'NA') AS artist_name,
  CASE count % 5 WHEN 0 THEN 'fields' ELSE 'count' END AS reason
FROM rounded WHERE count % 5 <= 1""",
    ),
    "json_broken_rows": _with(
        _PLAYS + _ROUNDED_PLAYLIST,
        """
SELECT who, coalesce(track_name, '') AS track_name, 'fields' AS reason
FROM rounded WHERE count % 5 <= 1""",
    ),
    "stacked_user_files": _with(
        _PLAYS,
        """
SELECT * EXCLUDE (event_id, duration_ms) REPLACE (
    CASE WHEN username <> 'user_a' THEN image END AS image,
    CASE WHEN username <> 'user_a' THEN followers END AS followers),
  CASE WHEN username = 'user_b' THEN 'd' || hour END AS device
FROM plays""",
    ),
    "months_stored_again": _with(
        _PLAYS,
        """
, corrected AS (
  SELECT * FROM plays WHERE username = 'user_b' AND year(time) = 2024
    AND month(time) BETWEEN 3 AND 9 AND ms_played >= 60000
)
SELECT * FROM plays WHERE username <> 'user_b'
  OR date_trunc('month', time) NOT IN (SELECT date_trunc('month', time) FROM corrected)
UNION ALL SELECT * FROM corrected""",
    ),
    "merged_track_dim": _with(_TRACK_DIM, "SELECT * FROM track_dim"),
    "merged_artist_dim": _with(_ARTIST_DIM, "SELECT * FROM artist_dim"),
    "plays": _with(_PLAYS, "SELECT * FROM plays"),
    "user_plays": _with(_OWN, "SELECT * FROM own"),
    "all_plays_in_range": _with(_RANGE, "SELECT * FROM ranged"),
    "plays_by_months": _with(
        _PLAYS,
        """
SELECT * FROM plays
WHERE username = 'user_a' AND year(time) = 2024 AND month(time) BETWEEN 3 AND 9""",
    ),
    "top_tracks": _with(
        _OWN,
        f"""
SELECT row_number() OVER (ORDER BY songs_played DESC, minutes_listened DESC, track_name,
    artist_name, album_name, genre)::INTEGER AS nr, *
FROM (
  SELECT track_name, artist_name, album_name, genre, {_MINUTES} AS minutes_listened,
    count(*) AS songs_played
  FROM own
  WHERE ms_played > 30000 AND track_name IS NOT NULL AND artist_name IS NOT NULL
    AND album_name IS NOT NULL AND genre IS NOT NULL
  GROUP BY ALL
) ORDER BY nr LIMIT 5""",
    ),
    "top_tracks_all_time": _with(
        _PLAYS,
        f"""
SELECT track_name, artist_name, album_name, {_WHOLE_MINUTES} AS minutes_listened,
  count(*) AS songs_played
FROM plays
WHERE track_name IS NOT NULL AND artist_name IS NOT NULL AND album_name IS NOT NULL
GROUP BY ALL ORDER BY songs_played DESC, track_name, artist_name, album_name LIMIT 10""",
    ),
    "hourly_share": _with(_OWN, _share("hour", "hour")),
    "weekday_share": _with(
        _OWN,
        f"""
SELECT *, dayname(DATE '2024-01-01' + weekday - 1) AS day_of_week
FROM ({_share("CAST(isodow(time) AS INTEGER)", "weekday")})""",
    ),
    "daily_unique_artists": _with(
        _OWN,
        """
SELECT CAST(time AS DATE) AS date, count(DISTINCT artist_name)
  + max(CASE WHEN artist_name IS NULL THEN 1 ELSE 0 END) AS unique_artists_n
FROM own GROUP BY 1 ORDER BY 1""",
    ),
    "favourite_artist": _with(_OWN, _FAVOURITE),
    "favourite_artist_by_plays": _with(
        _OWN, _favourite("own", _ARTIST_KEYS, _WHOLE_MINUTES, "songs_played")
    ),
    "favourite_artist_all_time": _with(
        _PLAYS, _favourite("plays", "artist_name", _MINUTES, "songs_played")
    ),
    "artist_tempo_range": _with(
        _OWN,
        f"""
SELECT artist_name, min(tempo) AS min_tempo, max(tempo) AS max_tempo FROM plays
WHERE artist_name = (SELECT artist_name FROM ({_FAVOURITE})) GROUP BY 1""",
    ),
    "artist_tempo_density": _with(
        _OWN
        + _density(
            f"""SELECT tempo AS v FROM plays WHERE tempo IS NOT NULL
            AND artist_name = (SELECT artist_name FROM ({_FAVOURITE}))"""
        ),
        "",
    ),
    "top_track_names": _with(_OWN, _TOP_NAMES),
    "top_track_features": _with(_OWN + _FIRST_OF_TOP, _means("first_of_top")),
    "radar_frame": _with(
        _OWN + _FIRST_OF_TOP + f", features AS ({_means('first_of_top')})",
        _radar_rows("features"),
    ),
    "rank_listening_time": _with(
        _RANGE, f"SELECT username, {_MINUTES} AS minutes_listened FROM ranged GROUP BY 1"
    ),
    "rank_average_tempo": _with(
        _RANGE, "SELECT username, round(avg(tempo), 6) AS average_tempo FROM ranged GROUP BY 1"
    ),
    "rank_artist_count": _with(
        _RANGE,
        """
SELECT username, count(DISTINCT artist_name)
  + max(CASE WHEN artist_name IS NULL THEN 1 ELSE 0 END) AS artists_number
FROM ranged GROUP BY 1""",
    ),
    "rank_average_followers": _with(
        _RANGE,
        """
SELECT username, CAST(round_even(avg(followers), 0) AS BIGINT) AS average_followers_n
FROM (SELECT username, artist_name, avg(followers) AS followers FROM ranged GROUP BY ALL)
GROUP BY 1""",
    ),
    "favourite_genre": _with(
        _RANGE,
        """
SELECT username, genre AS fav_genre
FROM (SELECT username, genre, count(*) AS n FROM ranged WHERE genre IS NOT NULL GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY username ORDER BY n DESC, genre) = 1""",
    ),
    "rankings": _with(
        _RANGE,
        f"""
, artists AS (
  SELECT username, artist_name, avg(followers) AS followers FROM ranged GROUP BY ALL
), genres AS (
  SELECT username, genre FROM (SELECT username, genre, count(*) AS n FROM ranged WHERE genre IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY username ORDER BY n DESC, genre) = 1
)
SELECT r.username, r.minutes_listened, r.average_tempo, a.artists_number, a.average_followers_n, g.genre AS fav_genre
FROM (SELECT username, {_MINUTES} AS minutes_listened, round(avg(tempo), 6) AS average_tempo FROM ranged GROUP BY 1) AS r
JOIN (
  SELECT username, count(*) AS artists_number, CAST(round_even(avg(followers), 0) AS BIGINT) AS average_followers_n
  FROM artists GROUP BY 1
) AS a USING (username)
LEFT JOIN genres AS g USING (username)""",
    ),
    "mutual_artist": _with(
        _RANGE,
        f"SELECT * FROM ({_mutual('artist_name', 30)}) WHERE artist_name IS NOT NULL "
        "ORDER BY artist_name LIMIT 1",
    ),
    "mutual_track": _with(
        _RANGE,
        f"SELECT * FROM ({_mutual('artist_name, track_name', 10)}) "
        "WHERE track_name IS NOT NULL ORDER BY artist_name NULLS LAST, track_name LIMIT 1",
    ),
    "mutual_tracks_listed": _with(_RANGE, _mutual("artist_name, track_name", 10)),
    "mutual_artists_of_everyone": _with(
        _RANGE,
        """
SELECT artist_name, count(*) AS users, CAST(sum(n) AS BIGINT) AS total
FROM (
  SELECT artist_name, username, count(*) AS n FROM ranged WHERE username IS NOT NULL
  GROUP BY ALL HAVING count(*) > 30
) GROUP BY artist_name HAVING count(*) = (SELECT count(DISTINCT username) FROM ranged)""",
    ),
    "cumulative_minutes": _with(
        _RANGE,
        """
SELECT name, date, ms / CAST(60000 AS DOUBLE) AS total_minutes,
  CAST(sum(ms) OVER (PARTITION BY name ORDER BY date) AS BIGINT) / CAST(60000 AS DOUBLE) AS cumsum
FROM (
  SELECT username AS name, CAST(time AS DATE) AS date, CAST(sum(ms_played) AS BIGINT) AS ms
  FROM ranged
  WHERE (username <> 'user_c' OR time < TIMESTAMP '2024-12-08')
    AND (username <> 'user_b' OR CAST(time AS DATE) > DATE '2024-02-01')
  GROUP BY ALL
)""",
    ),
    "weekday_average_minutes": _with(
        _YEAR + _DAYS,
        """
SELECT p.weekday, dayname(DATE '2024-01-01' + p.weekday - 1) AS day_of_week,
  CAST(sum(ms) AS BIGINT) / CAST(60000 AS DOUBLE) / CAST(sum(days) AS BIGINT) AS time
FROM (
  SELECT CAST(isodow(time) AS INTEGER) AS weekday, month(time) AS month, year(time) AS year,
    sum(ms_played) AS ms
  FROM mine GROUP BY ALL
) p JOIN (
  SELECT isodow(date) AS weekday, month(date) AS month, year(date) AS year, count(*) AS days
  FROM days GROUP BY ALL
) d ON d.weekday = p.weekday AND d.month = p.month AND d.year = p.year
GROUP BY 1 ORDER BY 1""",
    ),
    "hourly_average_minutes": _with(
        _YEAR + _DAYS,
        f"""
SELECT hour, {_MINUTES} / (SELECT count(*) FROM days) AS time FROM mine
GROUP BY 1 ORDER BY 1""",
    ),
    "top_artists": _with(_YEAR, _TOP_ARTISTS),
    "artist_track_play_equivalents": _with(
        _YEAR + _SONGS,
        f"""
, lengths AS (
  SELECT track_name, duration_ms FROM songs
  QUALIFY row_number() OVER (PARTITION BY track_name ORDER BY time, duration_ms) = 1
), counted AS (
  SELECT artist_name, track_name,
    CAST(round_even(CAST(ms AS DOUBLE) / duration_ms, 0) AS BIGINT) AS times_played
  FROM (
    SELECT artist_name, track_name, CAST(sum(ms_played) AS BIGINT) AS ms FROM mine
    WHERE artist_name = {_TOP_ARTIST} AND track_name IS NOT NULL GROUP BY ALL
  ) LEFT JOIN lengths USING (track_name)
)
SELECT *, row_number() OVER (
    ORDER BY times_played DESC NULLS LAST, artist_name, track_name)::INTEGER AS lp
FROM counted ORDER BY lp LIMIT 10""",
    ),
    "artist_mean_features": _with(_PLAYS + _SONGS, _ARTIST_MEANS),
    "artist_radar": _with(
        _YEAR
        + _SONGS
        + f""",
features AS (SELECT * FROM ({_ARTIST_MEANS}) WHERE artist_name = {_TOP_ARTIST})""",
        _radar_rows("features"),
    ),
    "top_track_counts": _with(
        _YEAR,
        """
SELECT track_name, count(*) AS times_played, substr(track_name, 1, 16) AS label FROM mine
WHERE ms_played > 30000 AND track_name IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    ),
    "feature_distribution": _with(
        _PLAYS
        + _SONGS
        + _density(
            f"""SELECT valence AS v FROM songs WHERE person = 'user_a' AND {_COMPLETE}
            AND valence BETWEEN 0 AND 1"""
        ),
        "",
    ),
    "feature_distribution_heard": _with(
        _PLAYS
        + _SONGS
        + _density(
            f"""SELECT valence AS v FROM songs WHERE person = 'user_a' AND {_COMPLETE}
            AND valence BETWEEN 0 AND 1 AND track_name IN (
              SELECT track_name FROM plays WHERE username = 'user_a'
              AND year(time) = 2024 AND month(time) = 3)"""
        ),
        "",
    ),
    "compatibility_profile": _with(
        _PLAYS,
        "\nUNION ALL\n".join(
            f"""SELECT '{f}' AS feature,
  round(avg({f}) FILTER (username = 'user_a'), 6) AS left_value,
  round(avg({f}) FILTER (username = 'user_b'), 6) AS right_value,
  CAST(1 AS DOUBLE) AS background FROM plays"""
            for f in RADAR_FEATURES
        ),
    ),
    "shared_artists": _with(_PLAYS + _shared(100), "SELECT * FROM shared"),
    "compatibility_score": _with(_PLAYS + _shared(100), _SCORE),
    "compatibility_score_small_top": _with(_PLAYS + _shared(10), _SCORE),
    "compatibility_score_large_top": _with(_PLAYS + _shared(5000), _SCORE),
    "compatibility_artists": _with(
        _PLAYS + _shared(100),
        "SELECT artist_name, time_left FROM shared ORDER BY time_left DESC, artist_name LIMIT 3",
    ),
    "group_playlist": _with(
        _PLAYS + _PLAYLIST,
        """
SELECT artist_name, track_name, count(*) AS people,
  CAST(round_even(avg(count), 0) AS BIGINT) AS avg_count, round(avg(time), 6) AS avg_time,
  coalesce(min(image), 'default_value') AS image
FROM playlist WHERE who IN ('user_a', 'user_b', 'user_c') GROUP BY artist_name, track_name
ORDER BY people DESC, avg_count DESC, avg(time) DESC, artist_name, track_name LIMIT 15""",
    ),
}
ORACLES["enriched_csv_files"] = ORACLES["curated_plays"]
