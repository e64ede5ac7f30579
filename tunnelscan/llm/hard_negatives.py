"""Hard negatives by inner product, from lists that a cluster of anchors shares.

A component c becomes floor(256 * c); scores are integer inner products.  Anchors
are clustered by angle.  For a cluster with centre u whose members are at most b
from it, no member a scores more than |a| * |v| * cos(max(0, angle(u, v) - b)) with a
candidate v.  So the candidates are sorted by |v| * cos(...) once for the cluster,
and every member walks this list until the bound is below the score that it still
needs: what comes after cannot change its result.

Two walks: for the positives (best rows of the anchor's label), then for the
negatives of each positive score (best rows of other labels in the score window that
ends there).  Each walk takes two steps.  A cluster first searches the block of
candidates that its centre lies in, which gives the score it needs; then all other
blocks that its bound does not exclude.

Plan: centres are k-means of a bounded sample of anchors.  Candidates go to the
nearest centre and are dealt from there to blocks of about ``block_rows``, so a
crowded or identical group is split; anchors likewise to clusters and these to parts
of about ``part_rows``.  A task has one block and one part; a block is sent to each
part that needs it.  Results of the blocks are at most the wanted number for each
anchor and score, merged by a window.

Edge cases: a vector that is NULL, empty, or holds a NULL, non-finite or too large
component (2**45) takes no part, nor does a row with a NULL label or id; vectors of
different lengths are not compared; rows of the anchor's own id are no candidates;
repeated rows are candidates each, but equal anchors are one; anchors of one id
with different vectors or labels are mined each; equal scores go to the smaller id;
with fewer rows than wanted all are returned; a positive with a negative score has
no negatives; a score beyond 64 bits counts as the nearest 64-bit number; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunnelscan.llm.common import batch_of, integers, list_array, stage

POSITIVES = 5
NEGATIVES = 5
BLOCK_ROWS = 32_768
PART_ROWS = 32_768
# Anchors that share a list, and anchors for each centre of the k-means.
CLUSTER_ROWS = 512
ROWS_PER_CENTRE = 64
# Bounds of the k-means on the driver: its sample and its centres.
SAMPLE = 16_384
MAX_CENTRES = 512
# Candidates of a list scored at once.
STEP = 256
# Slack of the cosine bound, far above its rounding error.
SLACK = 1e-7

_KEY = ["anchor_id", "mark"]
_FOUND = pa.schema([("anchor_id", pa.int64()), ("mark", pa.int64()), ("cap", pa.int64()), ("vec_id", pa.int64()),
                    ("score", pa.int64())])
_FOUND_SQL = "anchor_id long, mark long, cap long, vec_id long, score long"
_LONG = (-(1 << 63), (1 << 63) - 1)


def _matrix(column, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _units(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one (zero vectors stay) and the lengths."""
    v = v.astype(np.float64)
    norm = np.sqrt((v * v).sum(axis=1))
    return v / np.where(norm > 0, norm, 1.0)[:, None], norm


def _angles(units: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centre, -1.0, 1.0))


def _centre(units: np.ndarray) -> np.ndarray:
    return _units(units.sum(axis=0, keepdims=True))[0][0]


def centres_of(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    """Spherical k-means of the distinct directions of a sample."""
    units = np.unique(_units(sample)[0], axis=0)
    rng = np.random.default_rng(seed)
    centres = units[rng.permutation(len(units))[:k]]
    for _ in range(rounds):
        near = (units @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (near == c).any():
                centres[c] = _centre(units[near == c])
    return centres


class Shared:
    """The candidates of one block, to be sorted for one cluster after another."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, exact: bool):
        self.ids, self.labels = ids, labels
        # Doubles hold every score exactly, or Python's integers do.
        self.v = v.astype(np.float64) if exact else v.astype(object)
        self.exact = exact
        self.units, self.norm = _units(v)

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        out = self.v[rows] @ q.T
        return out if self.exact else np.clip(out, *_LONG)

    def walk(self, own: np.ndarray, labels: np.ndarray, q: np.ndarray, needs: list, caps: list, same: bool, top: int):
        """For every member and every cap of it: the best (score, -id) entries of at
        most the cap and at least the need, ``top`` at most.  Also the number of
        scores computed."""
        units, norm = _units(q)
        centre = _centre(units)
        # A zero vector scores 0 with all: its angle is no matter.
        spread = float(np.where(norm > 0, _angles(units, centre), 0.0).max())
        bound = self.norm * (np.cos(np.maximum(_angles(self.units, centre) - spread, 0.0)) + SLACK)
        order = np.argsort(-bound, kind="stable")
        q = q.astype(np.float64 if self.exact else object)
        best = [[[] for _ in c] for c in caps]
        needs = [list(n) for n in needs]
        least = np.array([min(n, default=np.inf) for n in needs], dtype=object if not self.exact else np.float64)
        most = np.array([max(c, default=-np.inf) for c in caps], dtype=least.dtype)
        live, scored = np.arange(len(q)), 0
        for a in range(0, len(order), STEP):
            live = live[(bound[order[a]] * norm[live] + SLACK >= least[live]).astype(bool)]
            if not len(live):
                break
            rows = order[a:a + STEP]
            s = self.scores(rows, q[live])
            scored += s.size
            fits = self.labels[rows][:, None] == labels[live][None, :]
            hits = (s >= least[live]) & (s <= most[live]) & (fits if same else ~fits) & (
                self.ids[rows][:, None] != own[live][None, :])
            for k in np.flatnonzero(hits.any(axis=0)).tolist():
                m, at = int(live[k]), np.flatnonzero(hits[:, k])
                entries = [(int(x), -int(i)) for x, i in zip(s[at, k], self.ids[rows[at]])]
                for t, cap in enumerate(caps[m]):
                    merged = best[m][t] + [e for e in entries if needs[m][t] <= e[0] <= cap]
                    if len(merged) > len(best[m][t]):
                        best[m][t] = sorted(merged, reverse=True)[:top]
                        if len(best[m][t]) == top:
                            needs[m][t] = best[m][t][-1][0]
                least[m] = min(needs[m])
        return best, scored


def _route(centres: np.ndarray, dim: int):
    kinds = pa.schema([("row", pa.int64()), ("route", pa.int64()), ("angle", pa.float64()), ("norm", pa.float64())])

    def run(batches):
        for batch in batches:
            v = _matrix(batch.column("v"), dim)
            for a in range(0, len(v), 4096):
                units, norm = _units(v[a:a + 4096])
                cosine = units @ centres.T
                near = cosine.argmax(axis=1)
                angle = np.arccos(np.clip(cosine[np.arange(len(near)), near], -1.0, 1.0))
                extra = batch_of(kinds, np.zeros(len(near), np.int64), near, angle, norm)
                part = batch.slice(a, len(near))
                yield pa.RecordBatch.from_arrays(part.columns + extra.columns[1:], names=part.schema.names + kinds.names[1:])
    return run


def _search(dim: int, exact: bool, same: bool, top: int):
    """Walks of all clusters of a part through a block."""
    def run(key, block, anchors):
        out = []
        if block.num_rows and anchors.num_rows:
            shared = Shared(block["vec_id"].to_numpy(), block["label"].to_numpy(), _matrix(block["v"], dim), exact)
            ids, marks = anchors["anchor_id"].to_numpy(), anchors["mark"].to_numpy()
            labels, q = anchors["label"].to_numpy(), _matrix(anchors["v"], dim)
            needs, caps = anchors["needs"].to_pylist(), anchors["caps"].to_pylist()
            clusters = anchors["cluster"].to_numpy()
            for c in np.unique(clusters):
                at = np.flatnonzero(clusters == c)
                best, _ = shared.walk(ids[at], labels[at], q[at], [needs[k] for k in at], [caps[k] for k in at], same, top)
                out += [(ids[k], marks[k], cap, -i, s) for k, lists in zip(at, best)
                        for cap, entries in zip(caps[k], lists) for s, i in entries]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), _FOUND)] if out
                        else [pa.array([], f.type) for f in _FOUND], schema=_FOUND)
    return run


def _reaching(centres: np.ndarray, radius: np.ndarray, norms: np.ndarray, dim: int):
    """Routes with candidates that the bound of a cluster does not exclude."""
    kinds = pa.schema([("cluster", pa.int64()), ("part", pa.int64()), ("route", pa.int64())])

    def run(key, members):
        units, norm = _units(_matrix(members["v"], dim))
        centre = _centre(units)
        spread = float(np.where(norm > 0, _angles(units, centre), 0.0).max())
        near = np.maximum(_angles(centres, centre) - radius - spread, 0.0)
        bound = np.where(norms >= 0, norms * (np.cos(np.minimum(near, np.pi)) + SLACK), -np.inf)
        least = np.array([float(min(n)) for n in members["needs"].to_pylist()])
        reach = (bound[:, None] * norm[None, :] + SLACK >= least[None, :]).any(axis=1) & (norms >= 0)
        routes = np.flatnonzero(reach)
        return pa.table([pa.array(np.full(len(routes), key[0].as_py())), pa.array(np.full(len(routes), key[1].as_py())),
                         pa.array(routes)], schema=kinds)
    return run


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy(*_KEY, "cap").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


class _Index:
    """Candidates of one length in blocks, anchors in clusters and parts."""

    def __init__(self, rows: DataFrame, dim: int, n_anchors: int, largest: int, block_rows: int, part_rows: int,
                 cluster_rows: int):
        self.dim, self.exact = dim, largest * largest * dim < 1 << 53
        sample = rows.where("asks").orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).toArrow()
        self.centres = centres_of(_matrix(sample["v"], dim), min(MAX_CENTRES, -(-n_anchors // ROWS_PER_CENTRE)))
        ddl = "vec_id long, label long, v array<long>, asks boolean, seq long, route long, angle double, norm double"
        routed = stage(rows.withColumn("seq", F.monotonically_increasing_id()).mapInArrow(_route(self.centres, dim), ddl), "routed")
        # At most MAX_CENTRES rows.
        stats = routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("a"),
                                            F.max("angle").alias("radius"), F.max("norm").alias("norm")).collect()
        self.radius, self.norms = np.zeros(len(self.centres)), np.full(len(self.centres), -1.0)
        deals, first = [], 0
        for r in sorted(stats, key=lambda r: r["route"]):
            self.radius[r["route"]], self.norms[r["route"]] = r["radius"], r["norm"]
            clusters = -(-r["a"] // cluster_rows)
            deals.append((r["route"], -(-r["n"] // block_rows), clusters, first))
            first += clusters
        self.deals = rows.sparkSession.createDataFrame(deals, "route long, blocks long, clusters long, first long")
        dealt = routed.join(F.broadcast(self.deals), "route")
        self.pages = dealt.select(self._block(F.pmod(F.xxhash64("seq"), "blocks")).alias("block"), "vec_id", "label", "v")
        mark = F.xxhash64("label", "v")
        dealt = dealt.withColumn("mark", mark).withColumn("sub", F.expr("pmod(xxhash64(vec_id, mark), clusters)"))
        per_part = max(1, part_rows // cluster_rows)
        self.anchors = stage(dealt.where("asks").select(
            F.col("vec_id").alias("anchor_id"), "mark", "label", "v", (F.col("first") + F.col("sub")).alias("cluster"),
            F.expr(f"(first + sub) div {per_part}").alias("part"),
            self._block(F.expr("pmod(sub, blocks)")).alias("home")).dropDuplicates(["anchor_id", "label", "v"]), "anchors")

    @staticmethod
    def _block(number: Column) -> Column:
        return F.col("route") * F.lit(1 << 32) + number

    def search(self, targets: DataFrame, same: bool, top: int) -> DataFrame:
        """The ``top`` best rows of each anchor and cap.  ``targets``: for each anchor
        (``anchor_id``, ``mark``) the caps of its scores and the least score of each."""
        walks = _search(self.dim, self.exact, same, top)
        asked = stage(self.anchors.join(targets, _KEY), "asked")
        home = (self.pages.groupBy("block").cogroup(asked.groupBy("home")).applyInArrow(walks, _FOUND_SQL))
        found = stage(_best(home, top).drop("rank"), "home")
        # The score that an anchor still needs for a cap: its last wanted one so far.
        known = found.groupBy(*_KEY, "cap").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low")).where(
            F.col("n") >= top).groupBy(*_KEY).agg(F.map_from_entries(F.collect_list(F.struct("cap", "low"))).alias("low"))
        asked = asked.join(known, _KEY, "left").withColumn("needs", F.when(F.col("low").isNull(), F.col("needs")).otherwise(
            F.zip_with("caps", "needs", lambda c, n: F.coalesce(F.element_at("low", c), n)))).drop("low")
        asked = stage(asked, "needs")
        routes = asked.groupBy("cluster", "part").applyInArrow(
            _reaching(self.centres, self.radius, self.norms, self.dim), "cluster long, part long, route long")
        wanted = (routes.select("part", "route").distinct().join(F.broadcast(self.deals), "route")
                  .select("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("b"), "route")
                  .select("part", self._block(F.col("b")).alias("block")))
        wanted = stage(wanted, "wanted")
        copies = self.pages.join(wanted, "block")
        members = asked.join(wanted, "part").where("home <> block")
        rest = (copies.groupBy("block", "part").cogroup(members.groupBy("block", "part")).applyInArrow(walks, _FOUND_SQL))
        return _best(found.unionByName(rest), top)


def mine(vectors: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding",
         positives: int = POSITIVES, negatives: int = NEGATIVES, block_rows: int = BLOCK_ROWS, part_rows: int = PART_ROWS,
         cluster_rows: int = CLUSTER_ROWS) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and
    ``negative_score``: for every row for which ``is_anchor`` holds and each of its best
    rows of the same ``label``, the best rows of other labels that score at most as
    much and at least four fifths of it."""
    rows = stage(vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                                integers(F.col(f"`{vec_col}`")).alias("v"), is_anchor.alias("asks"))
                 .where("vec_id is not null and label is not null and v is not null"), "vectors")
    largest = F.array_max(F.transform("v", F.abs))
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count_if("asks").alias("a"), F.max(largest).alias("most")).where(
        "a > 0").collect()
    out = vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                                   "positive_score long, negative_score long")
    for dim, n_anchors, most in sizes:
        index = _Index(rows.where(F.size("v") == dim), dim, n_anchors, most, block_rows, part_rows, cluster_rows)
        out = out.unionByName(_mine(index, positives, negatives))
    return out


def _mine(index: _Index, positives: int, negatives: int) -> DataFrame:
    ends = [F.array(F.lit(x).cast("long")) for x in _LONG]
    all_scores = index.anchors.select(*_KEY, ends[1].alias("caps"), ends[0].alias("needs"))
    best = stage(index.search(all_scores, True, positives).where("score >= 0").select(
        *_KEY, F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    caps = best.groupBy(*_KEY).agg(F.sort_array(F.collect_set("positive_score")).alias("caps"))
    # ceil(4 s / 5) = s - floor(s / 5)
    windows = caps.withColumn("needs", F.expr("transform(caps, s -> s - s div 5)"))
    found = index.search(windows, False, negatives)
    return best.join(found, (best["anchor_id"] == found["anchor_id"]) & (best["mark"] == found["mark"])
                     & (best["positive_score"] == found["cap"])).select(
        best["anchor_id"], "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def op12_hard_negatives(embeddings: DataFrame) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(embeddings, F.col("vec_id") % 100 == 0, label)
