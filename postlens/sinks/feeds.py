"""Per-state histogram artefacts and map feeds.

Drawing is out of scope: the data behind each chart is produced as tables.
``write_state_histograms`` writes the per-(state, label) counts partitioned
by state (one folder per state, the counterpart of one image per state);
``state_histogram_paths`` adds the artefact path column (or ``No data``);
``map_feed`` turns the state table into one GeoJSON-like feature per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import col_of
from ..operators.stats import group_label_counts, states_with_posts


def histogram_counts(df: DataFrame, label: str = "kmlabel", state_col: str = "state",
                     count_col: str = "user-id") -> DataFrame:
    return group_label_counts(df, (state_col, label), count_col, "count")


def write_state_histograms(df: DataFrame, path: str, label: str = "kmlabel", state_col: str = "state",
                           count_col: str = "user-id", fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write the counts behind each state's histogram, one folder per state.

    The counts table is small (states x labels); it is still written by the
    executors, partitioned by state, never gathered on the driver.
    """
    counts = histogram_counts(df, label, state_col, count_col)
    counts.repartition(col_of(state_col)).write.mode(mode).partitionBy(state_col).format(fmt).save(path)


def state_histogram_paths(states: DataFrame, df: DataFrame, label: str = "kmlabel", path: str = "image/hist",
                          states_key: str = "NAME10", state_col: str = "state", out: str | None = None) -> DataFrame:
    """Add ``hist_<label>``: ``<path>_<label>/hist_<label>_<state>.jpg`` for
    states with posts, ``No data`` otherwise."""
    out = out or f"hist_{label}"
    present = states_with_posts(states, df, states_key, state_col, present=True) \
        .select(col_of(states_key).alias("_present"))
    j = states.join(present, col_of(states_key) == F.col("_present"), "left")
    p = F.concat(F.lit(f"{path}_{label}/hist_{label}_"), col_of(states_key), F.lit(".jpg"))
    return j.withColumn(out, F.when(F.col("_present").isNotNull(), p).otherwise(F.lit(K.NO_DATA))).drop("_present")


def _as_text(c, no_data: str):
    return F.coalesce(col_of(c).cast("string"), F.lit(no_data))


def map_feed_columns(states: DataFrame, fill_col: str, keep=None, no_data: str = K.NO_DATA, extra=()) -> DataFrame:
    """Feed columns: every value as text with nulls as ``No data``, plus the
    number of distinct fill values (which sizes the palette), by a scalar
    subquery. ``extra`` columns pass through untouched."""
    keep = list(keep) if keep is not None else [c for c in states.columns if c != fill_col]
    fills = states.agg(F.count_distinct(_as_text(fill_col, no_data)).cast("int")).scalar()
    cols = [_as_text(c, no_data).alias(c) for c in [*keep, fill_col]]
    return states.select(*cols, fills.alias("n_fill"), *extra)


# FIXED VALUES: geometry kinds, by their WKT names.
GEOMETRIES = {"POINT": "Point", "LINESTRING": "LineString", "POLYGON": "Polygon", "MULTIPOINT": "MultiPoint",
              "MULTILINESTRING": "MultiLineString", "MULTIPOLYGON": "MultiPolygon"}
_WKT = r"(?is)^(?:SRID\s*=\s*\d+\s*;)?\s*([A-Z]+?)\s*(?:\bZM?|\bM)?\s*(\(.*\)|\bEMPTY)$"


def wkt_coordinates(kind, body):
    """The coordinates of a WKT body, ``(30 10, 40 40)`` say, as a JSON array."""
    t = F.regexp_replace(F.regexp_replace(body, r"\s+", " "), r" ?([(),]) ?", "$1")
    for pattern, put in ((r"(?<![0-9.eE])\+", ""), (r"(?<![0-9])\.(?=[0-9])", "0."), (r"(?<=[0-9])\.(?![0-9])", ""),
                         (r"(?<![0-9.eE])(?<![eE][+-])0+(?=[0-9])", "")):  # numbers as JSON writes them
        t = F.regexp_replace(t, pattern, put)
    t = F.translate(t, ", ", ";,")
    t = F.when(kind == "MULTIPOINT", F.regexp_replace(t, r"(?<=[(;])\(([^()]*)\)", "$1")).otherwise(t)
    t = F.translate(F.regexp_replace(t, r"[^();]+", "[$0]"), "();", "[],")
    return F.when(kind == "POINT", F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(t)


def geometry_json(c):
    """A geometry text as GeoJSON: GeoJSON stays, WKT (with or without an SRID, two or three dimensions)
    is parsed into nested arrays, anything else becomes ``null``, as a null does."""
    text = F.trim(col_of(c).cast("string"))
    is_json = text.startswith("{") & F.try_parse_json(text).isNotNull()
    kind, body = F.upper(F.regexp_extract(text, _WKT, 1)), F.regexp_extract(text, _WKT, 2)
    coordinates = F.when(F.upper(body) == "EMPTY", F.lit("[]")).when(body.rlike(r"^[-+0-9eE.,()\s]+$"), wkt_coordinates(kind, body))
    name = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in GEOMETRIES.items()])
    made = F.concat(F.lit('{"type":"'), name, F.lit('","coordinates":'), coordinates, F.lit("}"))
    made = F.when(F.try_parse_json(made).isNotNull(), made)
    return F.coalesce(F.when(is_json, text).otherwise(made), F.lit("null"))


def map_feed(states: DataFrame, fill_col: str, geometry_col: str = "geometry", keep=None) -> DataFrame:
    """One GeoJSON feature string per state: ``{"type":"Feature",
    "geometry":<geometry json>, "properties":{...}}``. The geometry is carried
    through the same projection, so nulls and repeated states are safe."""
    props_cols = [c for c in (keep or states.columns) if c != geometry_col]
    geom = geometry_json(geometry_col) if geometry_col in states.columns else F.lit("null")
    f = map_feed_columns(states, fill_col, keep=[c for c in props_cols if c != fill_col], extra=[geom.alias("_geometry")])
    props = F.to_json(F.struct(*[col_of(c) for c in props_cols], F.col("n_fill")))
    feature = F.concat(F.lit('{"type":"Feature","geometry":'), F.col("_geometry"), F.lit(',"properties":'), props, F.lit("}"))
    return f.select(*[col_of(c) for c in props_cols], feature.alias("feature"))
