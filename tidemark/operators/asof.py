"""Attributes as they were valid at one time and known at another.

Valid time (when a version holds) and recorded time (when it became known) span a plane. Of the versions of a key with ``valid_from <= x`` and ``recorded_at <= y`` the one with the latest
valid_from, then the latest recorded_at, then the greatest number is current at the point (x, y). The plane is split into disjoint rectangles in each of which one version is current: a version's
rectangle begins where it is valid and known; each version that becomes known later and is valid later cuts it off from there on, and one with the same valid_from ends it. A key with n versions has at most 2n rectangles.

Rectangles are indexed by a grid. A key with more than ``least`` versions has about sqrt(n) bands of valid time and as many of recorded time, between pivots that are picked from its versions by hash;
a key with fewer has one cell. Only cells that hold a point are built, each from what it must know and no more:

- the versions valid in its band of valid time that are known before its end, of those known before its start the best for each valid_from;
- those valid before its band that become known within it;
- the one that is current at its corner, which lies in the last earlier band that had anything known by then.

Rectangles are clipped to their cell, and every point looks only at the rectangles of its own cell.

Defined cases: a point with null key or times, or before the first known version, matches nothing; versions with null key, valid_from or recorded_at are never known; repeated rows
don't matter; a current version that is deleted matches nothing; an empty table gives an empty result.

Scale: no group is larger than a cell, which holds about 2 sqrt(n) versions of a key with n, and a hot key's points are spread over its cells, so that neither a hot key of the events nor one of the versions comes together in one
task. Pivots of a key are an array of about sqrt(n) times. Nothing is broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import materialise

START, END = -(1 << 63), (1 << 63) - 1
LEAST = 4
CELL = ["_key", "_b", "_c"]


def known_versions(versions: DataFrame, *, key: str, valid_from: str, recorded_at: str, version: str, deleted: str | None) -> DataFrame:
    """(_key, _vf, _rec, _tie, _deleted), times in microseconds; of versions equal in both times the one with the greatest number."""
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    v = versions.select(F.col(key).alias("_key"), F.unix_micros(F.col(valid_from).cast("timestamp")).alias("_vf"), F.unix_micros(F.col(recorded_at).cast("timestamp")).alias("_rec"), F.col(version).alias("_tie"), gone.alias("_deleted"))
    once = v.filter("_key is not null and _vf is not null and _rec is not null").groupBy("_key", "_vf", "_rec").agg(F.max(F.struct("_tie", "_deleted")).alias("x"))
    return once.select("_key", "_vf", "_rec", "x.*")


def grids(v: DataFrame, least: int) -> DataFrame:
    """(_key, _xs, _ys): the pivots of keys with more than ``least`` versions, where bands of valid and of recorded time begin."""
    many = v.groupBy("_key").agg(F.count("*").alias("_n")).filter(F.col("_n") > least).select("_key", F.ceil(F.sqrt("_n")).cast("bigint").alias("_every"))
    picked = v.join(many, "_key").filter(F.pmod(F.xxhash64("_vf", "_rec"), F.col("_every")) == 0)
    return picked.groupBy("_key").agg(F.array_sort(F.collect_set("_vf")).alias("_xs"), F.array_sort(F.collect_set("_rec")).alias("_ys"))


def band(pivots: str, at: Column) -> Column:
    """The number of pivots at or before a time; 0 for keys without a grid."""
    return F.coalesce(F.size(F.filter(pivots, lambda p: p <= at)), F.lit(0))


def _edge(pivots: str, i: Column) -> tuple[Column, Column]:
    """Where band i begins and ends."""
    none = F.lit(None).cast("bigint")
    return F.coalesce(F.when(i > 0, F.get(pivots, i - 1)).otherwise(none), F.lit(START)), F.coalesce(F.get(pivots, i), F.lit(END))


def cell_contents(placed: DataFrame, grid: DataFrame, asked: DataFrame) -> DataFrame:
    """(cell, _x0, _x1, _y0, _y1, _vs): for each asked cell its edges and the versions it must know.

    ``_vs``: array of (r, f, vf, rec, tie, deleted), where r and f are when the version is known and valid within the cell, and vf and rec when it really is.
    """
    row = F.struct(F.col("_vf").alias("vf"), F.col("_rec").alias("rec"), F.col("_tie").alias("tie"), F.col("_deleted").alias("deleted"))
    none = F.lit(None).cast("bigint")
    # of rows that are valid from the cell's side on, or known from its start on, one for each time that still tells them apart
    part = lambda df, f, r: df.select(*CELL, row.alias("v"), f.alias("_f"), r.alias("_r"))
    own = asked.join(placed.withColumnRenamed("_vb", "_b"), ["_key", "_b"]).filter("_vc <= _c")
    left = asked.filter("_b > 0").join(placed.withColumnRenamed("_vc", "_c"), ["_key", "_c"]).filter("_vb < _b")
    # the corner: the last earlier band of valid time with anything known before this band of recorded time
    first = placed.join(grid.select("_key"), "_key", "left_semi").groupBy("_key", "_vb").agg(F.min("_vc").alias("m")).groupBy("_key").agg(F.collect_list(F.struct(F.col("_vb").alias("b"), "m")).alias("_firsts"))
    reach = F.array_max(F.transform(F.filter("_firsts", lambda x: (x["b"] < F.col("_b")) & (x["m"] < F.col("_c"))), lambda x: x["b"]))
    corner = asked.filter("_b > 0 and _c > 0").join(first, "_key").select(*CELL, reach.alias("_vb")).filter("_vb is not null").join(placed, ["_key", "_vb"]).filter("_vc < _c")
    told = part(own, F.col("_vf"), F.when(F.col("_vc") == F.col("_c"), F.col("_rec"))).unionByName(part(left, none, F.col("_rec"))).unionByName(part(corner, none, none))
    content = told.groupBy(*CELL, "_f", "_r").agg(F.max("v").alias("v")).groupBy(*CELL).agg(F.collect_list("v").alias("_all"))
    (x0, x1), (y0, y1) = _edge("_xs", F.col("_b")), _edge("_ys", F.col("_c"))
    edged = content.join(grid, "_key", "left").select(*CELL, x0.alias("_x0"), x1.alias("_x1"), y0.alias("_y0"), y1.alias("_y1"), "_all")
    clipped = F.transform("_all", lambda v: F.struct(F.greatest(v["rec"], F.col("_y0")).alias("r"), F.greatest(v["vf"], F.col("_x0")).alias("f"), *(v[c].alias(c) for c in ("vf", "rec", "tie", "deleted"))))
    return edged.select(*CELL, "_x0", "_x1", "_y0", "_y1", F.array_sort(clipped).alias("_vs"))


def _rank(v: Column) -> Column:
    return F.struct(v["vf"], v["rec"], v["tie"])


def rectangles(contents: DataFrame) -> DataFrame:
    """(cell, x0, x1, y0, y1, tie, deleted): the disjoint rectangles of each cell."""
    span = "array<struct<x1:bigint,y0:bigint,y1:bigint>>"

    def of(v: Column) -> Column:
        beaten = F.exists("_vs", lambda w: (w["f"] == v["f"]) & (w["r"] <= v["r"]) & (_rank(w) > _rank(v)))
        ended = F.array_min(F.transform(F.filter("_vs", lambda w: (w["f"] == v["f"]) & (w["r"] > v["r"]) & (_rank(w) > _rank(v))), lambda w: w["r"]))
        first = F.array_min(F.transform(F.filter("_vs", lambda w: (w["f"] > v["f"]) & (w["r"] <= v["r"])), lambda w: w["f"]))
        later = F.filter("_vs", lambda w: (w["f"] > v["f"]) & (w["r"] > v["r"]))
        start = F.struct(F.coalesce(first, F.col("_x1")).alias("x1"), v["r"].alias("y0"), F.array().cast(span).alias("done"))

        def cut(s: Column, w: Column) -> Column:
            hit = (w["f"] < s["x1"]) & (w["r"] < F.coalesce(ended, F.col("_y1")))
            piece = F.array(F.struct(s["x1"].alias("x1"), s["y0"].alias("y0"), w["r"].alias("y1")))
            done = F.when(hit & (s["y0"] < w["r"]), F.concat(s["done"], piece)).otherwise(s["done"])
            return F.struct(F.when(hit, w["f"]).otherwise(s["x1"]).alias("x1"), F.when(hit, w["r"]).otherwise(s["y0"]).alias("y0"), done.alias("done"))

        pieces = F.aggregate(later, start, cut, lambda s: F.concat(s["done"], F.array(F.struct(s["x1"].alias("x1"), s["y0"].alias("y0"), F.coalesce(ended, F.col("_y1")).alias("y1")))))
        out = F.transform(pieces, lambda p: F.struct(v["f"].alias("x0"), p["x1"].alias("x1"), p["y0"].alias("y0"), p["y1"].alias("y1"), v["tie"].alias("tie"), v["deleted"].alias("deleted")))
        return F.when(~beaten, out)

    made = contents.select(*CELL, F.explode(F.flatten(F.filter(F.transform("_vs", of), lambda a: a.isNotNull()))).alias("r"))
    return made.select(*CELL, "r.*").filter("x0 < x1 and y0 < y1")


def located(events: DataFrame, grid: DataFrame, *, key: str, valid_at: str, known_at: str, whole: bool) -> DataFrame:
    """(cell, _x, _y, _row) of each point; with ``whole`` those that match nothing for want of a key or time stay."""
    row = F.struct(*(F.col(f"`{c}`") for c in events.columns))
    points = events.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{valid_at}`").alias("_x"), F.col(f"`{known_at}`").alias("_y"), row.alias("_row"))
    if not whole:
        points = points.filter("_key is not null and _x is not null and _y is not null")
    return points.join(grid, "_key", "left").select("_key", band("_xs", F.col("_x")).alias("_b"), band("_ys", F.col("_y")).alias("_c"), "_x", "_y", "_row")


def prepared(events: DataFrame, versions: DataFrame, *, key: str, event_time: str, valid_from: str, recorded_at: str, version: str, deleted: str | None, known_at: str | None, least: int, whole: bool) -> tuple[DataFrame, DataFrame]:
    """(points, contents of the cells that hold one). Versions, grids and points are each used several times and so cut from their lineage."""
    v = materialise(known_versions(versions, key=key, valid_from=valid_from, recorded_at=recorded_at, version=version, deleted=deleted), "asof-versions")
    grid = materialise(grids(v, least), "asof-grids")
    points = materialise(located(events, grid, key=key, valid_at=event_time, known_at=known_at or event_time, whole=whole), "asof-points")
    placed = v.join(grid, "_key", "left").select("_key", "_vf", "_rec", "_tie", "_deleted", band("_xs", F.col("_vf")).alias("_vb"), band("_ys", F.col("_rec")).alias("_vc"))
    return points, cell_contents(materialise(placed, "asof-placed"), grid, points.filter("_key is not null").select(*CELL).distinct())


def attributes_at_event(
    events: DataFrame, versions: DataFrame, *, key: str, event_time: str, valid_from: str, recorded_at: str, version: str, deleted: str | None = None, known_at: str | None = None, least: int = LEAST, how: str = "inner"
) -> DataFrame:
    """``events`` with the ``version`` (its number) that was current at ``event_time`` as known at ``known_at``, by default the same time.

    Both are columns in microseconds; ``valid_from`` and ``recorded_at`` are timestamps. All columns of the events stay; where one of them is named
    like ``version``, the new one gets the suffix ``_found``. With ``how="left"`` events without a version stay, with a null.
    """
    points, contents = prepared(events, versions, key=key, event_time=event_time, valid_from=valid_from, recorded_at=recorded_at, version=version, deleted=deleted, known_at=known_at, least=least, whole=how != "inner")
    boxes = rectangles(contents)
    inside = "p._key = r._key and p._b = r._b and p._c = r._c and p._x >= r.x0 and p._x < r.x1 and p._y >= r.y0 and p._y < r.y1"
    found = points.alias("p").join(boxes.alias("r"), F.expr(inside), how)
    if how == "inner":
        found = found.filter("not r.deleted")
    name = f"{version}_found" if version in events.columns else version
    return found.select("p._row.*", F.when(~F.col("r.deleted"), F.col("r.tie")).alias(name))


def cell_sizes(events: DataFrame, versions: DataFrame, *, key: str, event_time: str, valid_from: str, recorded_at: str, version: str, deleted: str | None = None, known_at: str | None = None, least: int = LEAST) -> DataFrame:
    """(_key, _b, _c, versions, rectangles) of each cell of the index that ``attributes_at_event`` builds for these points."""
    _, contents = prepared(events, versions, key=key, event_time=event_time, valid_from=valid_from, recorded_at=recorded_at, version=version, deleted=deleted, known_at=known_at, least=least, whole=False)
    contents = materialise(contents, "asof-cells")
    boxes = rectangles(contents).groupBy(*CELL).agg(F.count("*").alias("rectangles"))
    return contents.select(*CELL, F.size("_vs").alias("versions")).join(boxes, CELL, "left")
