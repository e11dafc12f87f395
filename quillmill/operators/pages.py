"""Tables and boxes of converted pages."""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import profiles
from ..functions.numerals import let
from ..functions.text import collapse_runs, squeeze, strip, text, undouble


def cell(c: Column) -> Column:
    """A cell's text: doubled characters repaired, blanks thinned."""
    return squeeze(collapse_runs(undouble(c)))


def rectangles_meet(a: Column, b: Column) -> Column:
    """Whether two structs (x0, y0, x1, y1) overlap."""
    return ~((a["x1"] < b["x0"]) | (b["x1"] < a["x0"]) | (a["y1"] < b["y0"]) | (b["y1"] < a["y0"]))


def outside_tables(words: DataFrame, tables: DataFrame, page: str = "page") -> DataFrame:
    """Words (page, x0, y0, x1, y1, …) that no table's box of their page touches."""
    w, t = words.alias("w"), tables.alias("t")
    box = lambda n: {k: F.col(f"{n}.{k}") for k in ("x0", "y0", "x1", "y1")}
    return w.join(t, (F.col(f"w.{page}") == F.col(f"t.{page}")) & rectangles_meet(box("w"), box("t")), "left_anti")


#: Widths of a tile in radii, ticks or boxes that a tile holds in one part, boxes in a leaf of a tree, and ticks that walk it together.
TILE, PART, LEAF, WALK = 8, 200_000, 8, 16_384


class Boxes:
    """A tree over points that halves them by turns of the wider side; finds the nearest point, of equals the first."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        order = np.lexsort((np.arange(len(x)), y, x))
        px, py = x[order], y[order]
        order = np.sort(order[np.r_[True, (px[1:] != px[:-1]) | (py[1:] != py[:-1])]])  # one of each place
        depth = 0
        while len(order) > LEAF << depth:
            depth += 1
        self.depth, cuts = depth, np.array([0, len(order)])
        self.x, self.y = x, y
        self.bounds, self.cuts = [], []
        for level in range(depth + 1):
            px, py, lo = x[order], y[order], cuts[:-1]
            b = np.stack([np.minimum.reduceat(px, lo), np.maximum.reduceat(px, lo), np.minimum.reduceat(py, lo), np.maximum.reduceat(py, lo)])
            self.bounds.append(b)
            self.cuts.append(cuts)
            if level < depth:
                sizes = np.diff(cuts)
                wide = np.repeat(b[1] - b[0] >= b[3] - b[2], sizes)
                order = order[np.lexsort((np.where(wide, px, py), np.repeat(np.arange(len(sizes)), sizes)))]
                cuts = np.insert(cuts, np.arange(1, len(cuts)), cuts[:-1] + sizes // 2)
        self.order = order

    def _away(self, level: int, node: np.ndarray, tx: np.ndarray, ty: np.ndarray) -> np.ndarray:
        """The distance of points to the bounds of nodes, a little less for rounding."""
        x0, x1, y0, y1 = self.bounds[level][:, node]
        dx, dy = np.maximum(np.maximum(x0 - tx, tx - x1), 0), np.maximum(np.maximum(y0 - ty, ty - y1), 0)
        return np.sqrt(dx * dx + dy * dy) * (1 - 1e-12)

    def _look(self, t: np.ndarray, leaf: np.ndarray, tx: np.ndarray, ty: np.ndarray, best: np.ndarray, at: np.ndarray) -> None:
        lo, n = self.cuts[-1][leaf], np.diff(self.cuts[-1])[leaf]
        who = np.repeat(t, n)
        box = self.order[np.arange(n.sum()) + np.repeat(lo - np.cumsum(n) + n, n)]
        dx, dy = self.x[box] - tx[who], self.y[box] - ty[who]
        d = np.sqrt(dx * dx + dy * dy)
        near = d <= best[who]
        who, box, d = who[near], box[near], d[near]
        first = np.lexsort((box, d, who))
        first = first[np.r_[True, who[first][1:] != who[first][:-1]][: len(first)]]
        who, box, d = who[first], box[first], d[first]
        better = (d < best[who]) | ((d == best[who]) & (box < at[who]))
        best[who[better]], at[who[better]] = d[better], box[better]

    def nearest(self, tx: np.ndarray, ty: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """(place of the nearest point closer than radius or -1, distance) of each tick."""
        found = [self._walk(tx[i : i + WALK], ty[i : i + WALK], radius) for i in range(0, len(tx), WALK)]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _walk(self, tx: np.ndarray, ty: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        t = np.arange(len(tx))
        best, at = np.full(len(tx), np.nextafter(radius, -np.inf)), np.full(len(tx), len(self.x))
        node = np.zeros(len(tx), np.int64)
        for level in range(1, self.depth + 1):  # down the nearer child, for a first bound
            node = 2 * node + (self._away(level, 2 * node + 1, tx, ty) < self._away(level, 2 * node, tx, ty))
        self._look(t, node, tx, ty, best, at)
        first = node
        # every other leaf in reach, in rounds of at most WALK visits, nearest halves of the tree on top
        todo = [(0, t, np.zeros(len(t), np.int64))]
        while todo:
            level, who, node = todo.pop()
            if len(who) > WALK:
                todo.append((level, who[WALK:], node[WALK:]))
                who, node = who[:WALK], node[:WALK]
            reach = self._away(level, node, tx[who], ty[who]) <= best[who]
            who, node = who[reach], node[reach]
            if not len(who):
                continue
            if level == self.depth:
                other = node != first[who]
                self._look(who[other], node[other], tx, ty, best, at)
                continue
            left, right = (self._away(level + 1, 2 * node + i, tx[who], ty[who]) for i in (0, 1))
            near = 2 * node + (right < left)
            todo += [(level + 1, who, near ^ 1), (level + 1, who, near)]
        return np.where(at < len(self.x), at, -1), best


def nearest_within(ticks: DataFrame, boxes: DataFrame, radius: float = 25.0, page: str = "page") -> DataFrame:
    """(page, tick, box): the nearest box within the radius of each tick, of equals the least.

    Pages are cut into tiles of TILE radii; a box goes to every tile that its radius touches, a tick
    to its own.  A tile's boxes become a tree that its ticks walk, so that crowded pages make no
    pairs.  Tiles above PART ticks or boxes are dealt into parts, each of ticks against each of boxes.
    """
    wide, reach = TILE * radius, radius * (1 + 1e-9)
    tile = lambda c, add=0.0: F.floor((F.col(c) + add) / wide)
    here = lambda d: d.where(" and ".join(f"{c} is not null and abs({c}) < double('Infinity')" for c in ("x", "y")) + f" and {page} is not null")
    own = lambda d: here(d.select(page, "id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")))
    t = own(ticks).withColumn("gx", tile("x")).withColumn("gy", tile("y"))
    span = lambda c: F.explode(F.sequence(tile(c, -reach), tile(c, reach)))
    b = own(boxes).withColumn("gx", span("x")).withColumn("gy", span("y"))
    at = [page, "gx", "gy"]
    none = [F.lit(None).cast(d.schema["id"].dataType) for d in (ticks, boxes)]
    both = t.select(*at, "x", "y", F.col("id").alias("tick"), none[1].alias("box"), F.lit(True).alias("is_tick")).unionByName(b.select(*at, "x", "y", none[0].alias("tick"), F.col("id").alias("box"), F.lit(False).alias("is_tick")))
    sizes = both.groupBy(at).agg(F.count_if("is_tick").alias("nt"), F.count_if(~F.col("is_tick")).alias("nb")).where((F.col("nt") > PART) | (F.col("nb") > PART))
    parts = sizes.select(*at, *[F.ceil(F.col(n) / PART).cast("int").alias(k) for n, k in (("nt", "pt"), ("nb", "pb"))])
    both = both.join(F.broadcast(parts), at, "left")  # no more than the rows over PART
    dealt = lambda k: F.pmod(F.xxhash64("tick", "box", "x", "y"), F.greatest(F.coalesce(k, F.lit(1)), F.lit(1))).cast("int")
    every = lambda k: F.sequence(F.lit(0), F.greatest(F.coalesce(k, F.lit(1)), F.lit(1)) - 1)
    both = both.withColumn("i", F.explode(F.when(F.col("is_tick"), F.array(dealt(F.col("pt")))).otherwise(every(F.col("pt"))))).withColumn("j", F.explode(F.when(F.col("is_tick"), every(F.col("pb"))).otherwise(F.array(dealt(F.col("pb"))))))
    keys = [*at, "i", "j"]
    # boxes by id, so that of equals the first is the least
    placed = both.select(*keys, "is_tick", "tick", "box", "x", "y").repartition(*keys).sortWithinPartitions(*keys, "is_tick", "box")
    own_page = placed.schema[page].dataType
    out = T.StructType([T.StructField(page, own_page), T.StructField("tick", ticks.schema["id"].dataType), T.StructField("box", boxes.schema["id"].dataType), T.StructField("d", T.DoubleType())])

    def solved(rows: pa.Table) -> pa.RecordBatch | None:
        n = rows.num_rows - pc.sum(rows["is_tick"]).as_py()
        if n in (0, rows.num_rows):
            return None
        x, y = rows["x"].to_numpy(), rows["y"].to_numpy()
        box, d = Boxes(x[:n], y[:n]).nearest(x[n:], y[n:], radius)
        hit = np.flatnonzero(box >= 0)
        cut = rows.take(pa.array(hit + n))
        columns = [cut[page], cut["tick"], rows["box"].take(pa.array(box[hit])), pa.chunked_array([d[hit]])]
        return pa.table(columns, names=out.names).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, last = [], None
        for b in batches:
            if not b.num_rows:
                continue
            new = np.zeros(b.num_rows, bool)
            for k in keys:
                c = b.column(k)
                new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
            key = [b.column(k)[0].as_py() for k in keys]
            new[0] = last is not None and key != last
            at = 0
            for cut in np.flatnonzero(new):
                done, at = solved(pa.Table.from_batches([*kept, b.slice(at, cut - at)])), cut
                kept = []
                if done is not None:
                    yield from done.to_batches()
            kept.append(b.slice(at))
            last = [b.column(k)[b.num_rows - 1].as_py() for k in keys]
        if kept and (done := solved(pa.Table.from_batches(kept))) is not None:
            yield from done.to_batches()

    return placed.mapInArrow(run, out).groupBy(page, "tick").agg(F.min(F.struct("d", "box"))["box"].alias("box"))


def align(lines: list[str], found: list[str]) -> list[int | None]:
    """For each line the place of the first equal key in found after the one taken last, or None; an empty key has none."""
    places: dict[str, list[int]] = {}
    for i, key in enumerate(found):
        places.setdefault(key, []).append(i)
    out, after = [], 0
    for key in lines:
        own = places.get(key, []) if key else []
        at = bisect.bisect_left(own, after)
        out.append(own[at] if at < len(own) else None)
        after = after if out[-1] is None else out[-1] + 1
    return out


def aligned_lines(lines: DataFrame, found: DataFrame, page: str = "page", order: str = "n", key: str = "key", value: str = "checked") -> DataFrame:
    """(page, n, value): lines with the boolean of the detected line that they align to, false for none.

    Both sides have (page, n, key); a page's lines are walked once, in order.  Null keys are
    empty, a page without detected lines has none, and of equal n the lesser key is first.
    """

    def side(d: DataFrame, name: str, v: Column) -> DataFrame:
        item = F.struct(F.col(order).cast("long").alias("n"), text(F.col(key)).alias("k"), v.alias("v"))
        return d.groupBy(page).agg(F.array_sort(F.collect_list(item)).alias(name))

    both = side(lines, "own", F.lit(False)).join(side(found, "seen", F.coalesce(value, F.lit(False))), page, "left")
    cols = both.select(page, F.col("own.n").alias("n"), F.col("own.k").alias("k"), F.coalesce("seen.k", F.array().cast("array<string>")).alias("f"), F.coalesce("seen.v", F.array().cast("array<boolean>")).alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hits = [[at is not None and v[at] for at in align(k, f)] for k, f, v in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(hits, pa.list_(pa.bool_()))], names=["page", "n", "v"])

    kind = T.StructType([T.StructField("page", cols.schema[page].dataType), T.StructField("n", T.ArrayType(T.LongType())), T.StructField("v", T.ArrayType(T.BooleanType()))])
    return cols.mapInArrow(run, kind).select(F.col("page").alias(page), F.explode(F.arrays_zip("n", "v")).alias("x")).select(page, F.col("x.n").alias(order), F.col("x.v").alias(value))


def probable_table(rows: Column) -> Column:
    """Two rows and columns at least, two known terms in the first row, and short cells."""
    head = F.transform(F.get(rows, F.lit(0)), lambda c: F.coalesce(c, F.lit("")))
    terms = F.size(F.filter(F.array(*map(F.lit, profiles.HEADER_TERMS)), lambda t: F.exists(head, lambda c: F.contains(c, t))))
    cells = F.flatten(rows)
    mean = F.aggregate(cells, F.lit(0), lambda a, c: a + F.length(F.coalesce(c, F.lit("")))) / F.greatest(F.size(cells), F.lit(1))
    wide = F.array_max(F.transform(rows, lambda r: F.size(r)))
    return (F.size(rows) >= 2) & (wide >= 2) & (terms >= 2) & (mean < 120)


def _rising(values: list[str]) -> bool:
    """Whether filled values are numbers that never fall."""
    ns = [int(v) for v in values if v.strip().isdigit()]
    return len(ns) >= 2 and len(ns) == len([v for v in values if v.strip()]) and ns == sorted(ns)


def linear_table(rows: list[list[str | None]], header_rows: int | None = None) -> list[str]:
    """A line `header：value；…` for each row of a table.

    Merged header cells carry down their row, two-line headers are joined, and a row without an
    id and with two cells at most goes on with the row before it.
    """
    body = [[re.sub(r"\s+", " ", c or "").strip() for c in r] for r in rows if any((c or "").strip() for c in r)]
    if not body:
        return []
    width = max(map(len, body))
    body = [r + [""] * (width - len(r)) for r in body]
    depth = header_rows if header_rows is not None else 2 if len(body) > 2 and any(not c for c in body[0]) and not any(c.isdigit() for c in body[1]) else 1
    head = [""] * width
    for r in body[:depth]:
        carried = ""
        for j, c in enumerate(r):
            if depth > 1 and r is body[0]:
                carried = c or carried
                c = carried
            head[j] = f"{head[j]}/{c}" if head[j] and c and c != head[j] else head[j] or c
    data = body[depth:]
    ids = next((j for j in range(width) if _rising([r[j] for r in data])), None)
    merged: list[list[str]] = []
    for r in data:
        cells = [j for j, c in enumerate(r) if c]
        if merged and ids is not None and not r[ids] and len(cells) <= 2:
            for j in cells:
                merged[-1][j] = f"{merged[-1][j]}；{r[j]}" if merged[-1][j] else r[j]
        else:
            merged.append(list(r))
    return ["；".join(f"{h}：{c}" if h else c for h, c in zip(head, r) if c) for r in merged]


def linearize(rows: Column) -> Column:
    """linear_table() of an array of rows of cells."""

    def lines(rows):
        return linear_table([list(r) if r is not None else [] for r in rows]) if rows is not None else []

    return F.udf(lines, "array<string>", useArrow=True)(rows)


_TICK = "^(☐✓|☑|✓|☐ ✓)$"


def checkbox_lines(c: Column) -> Column:
    """Lines that begin with a box as Markdown tasks, `- [x]` for ticked ones.

    A tick alone on a line ticks the line before; a contract at a fixed price is ticked if its line
    or the next one states an amount.
    """
    kind = "array<struct<line:string,on:boolean>>"
    item = lambda line, on: F.array(F.struct(line.alias("line"), on.alias("on"))).cast(kind)

    def step(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        ticked = F.concat(F.slice(done, 1, F.size(done) - 1), item(F.regexp_replace(last["line"], "^([^☐]*)☐", "$1☑"), F.lit(True)))
        return F.when(strip(x).rlike(_TICK) & (F.size(done) > 0), ticked).otherwise(F.concat(done, item(x, F.contains(x, F.lit("☑")))))

    def shown(x: Column, near: Column) -> Column:
        priced = F.contains(x["line"], F.lit(profiles.FIXED_PRICE)) & near.rlike(profiles.AMOUNT)
        box = r"^([ \t]*)([☐☑])\s*(.*)$"
        body = F.btrim(F.regexp_replace(F.regexp_extract(x["line"], box, 3), "[✓☐]", ""), F.lit("：: \t"))
        mark = F.when(x["on"] | priced, "x").otherwise(" ")
        return F.when(x["line"].rlike(box), F.concat(F.regexp_extract(x["line"], box, 1), F.lit("- ["), mark, F.lit("] "), body)).otherwise(x["line"])

    lines = F.aggregate(F.split(text(c), "\n"), F.array().cast(kind), step)
    near = lambda all_, x, i: F.concat_ws(" ", x["line"], F.get(all_, i + 1)["line"])
    return F.array_join(let(lines, lambda all_: F.transform(all_, lambda x, i: shown(x, near(all_, x, i)))), "\n")


def markup_text(c: Column) -> Column:
    """Text of simple markup: scripts and tags cut, common references decoded."""
    t = F.regexp_replace(text(c), r"(?is)<(script|style)[^>]*>.*?</\1>|<!--.*?-->", " ")
    t = F.regexp_replace(t, "<[^>]*>", " ")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        t = F.replace(t, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(t, "[ \t\r\n\f]+", " "))
