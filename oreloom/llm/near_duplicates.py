"""MinHash near-duplicates by an inverted join over signature coordinates.

1. One pass over the texts gives each document its number of distinct shingles, a 128-bit hash of the set and a MinHash
   signature. Documents with equal sets are one class, carried on by its smallest id.
2. Every class is posted under its coordinate-value pairs; pairs held by one class alone can match nothing. Two classes
   that agree in ``need`` of ``coords`` coordinates share one of the ``coords - need + 1`` rarest pairs of each (prefix
   rule, with one global order by frequency), so only those are kept, and classes with fewer than ``need`` shared pairs
   are skipped altogether.
3. Classes that agree in a whole band of ``BAND`` coordinates are joined into clusters beforehand (a star for each band
   value). Inside a posting list the collisions of whole signatures are counted, skipping pairs of one cluster; lists
   are cut into blocks of ``LIST`` classes and met block against block, so no list has to fit one task and no pair
   becomes a row: what leaves a task is a spanning forest, between clusters, of the pairs above the match threshold.
4. The components of stars and forest contain every link. All documents of one are confirmed against its smallest on their
   full shingle sets, once each. Pairs of documents linked to the smallest need no more; the others are confirmed among
   themselves and against these, again block against block. The components of the confirmed links are the result.

``need`` lies ``Z`` standard deviations below the matches expected at the similarity threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _io
from ._graph import EDGES, Forest, components, edge_batch
from ._text import NONSPACE, Words, mix, parts

COORDS, BAND, Z = 64, 16, 5.0
#: Classes of a posting list, and documents and shingles of a candidate component, that meet in one task from either side.
LIST, BLOCK, BLOCK_SHINGLES = 256, 256, 1 << 20
#: Tasks over which the rows of one key are dealt, and bytes that a task of block pairs reads.
SALTS, TASK_BYTES = 32, 128 << 20
#: Member ids up to this number are broadcast to the scan of the texts (16 MB); beyond it the join shuffles.
BROADCAST_IDS = 1_000_000


def need_of(percent: int, coords: int = COORDS) -> int:
    j = percent / 100
    return max(1, math.floor(coords * j - Z * math.sqrt(coords * j * (1 - j))))


def _shingles(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text that has a word."""
    for lo, data, at in parts(column):
        w = Words(data, at, NONSPACE)
        full = w.grams(np.arange(max(0, len(w.hash) - k + 1)), k)
        for i, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
            if b - a >= k:
                h = np.sort(full[a : b - k + 1])
                yield lo + i, h[np.concatenate(([True], h[1:] != h[:-1]))]
            elif b > a:
                yield lo + i, w.grams(np.array([a]), b - a)


def _sketch(batches: Iterator[pa.RecordBatch], k: int, coords: int) -> Iterator[pa.RecordBatch]:
    by = mix(np.arange(1, coords + 1, dtype=np.uint64)) | np.uint64(1)
    for batch in batches:
        n = batch.num_rows
        count = np.zeros(n, dtype=np.int64)
        key = np.zeros((n, 2), dtype=np.uint64)
        sig = np.zeros((n, coords), dtype=np.int32)
        for row, h in _shingles(batch.column(1), k):
            count[row] = len(h)
            key[row] = mix(h).sum(), mix(h ^ np.uint64(0x5851F42D4C957F2D)).sum()
            for lo in range(0, coords, 16):
                step = max(1, 16384 // 16)
                least = (h[:step, None] * by[None, lo : lo + 16]).min(axis=0)
                for s in range(step, len(h), step):
                    np.minimum(least, (h[s : s + step, None] * by[None, lo : lo + 16]).min(axis=0), out=least)
                sig[row, lo : lo + 16] = (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
        none = count == 0
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * coords + 1, coords, dtype=np.int32)), pa.array(sig.reshape(-1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count), pa.array([x.tobytes() for x in key], pa.binary(), mask=none), lists], names=["id", "n", "key", "sig"])


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Batches of whole groups: rows are sorted by the first ``keys`` columns and a group may go on in the next batch."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        own = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        last = np.ones(batch.num_rows, dtype=bool)
        for c in own:
            last &= c == c[-1]
        cut = batch.num_rows - int(last.sum())
        if rest and (cut or any(rest[-1].column(i)[-1] != batch.column(i)[0] for i in range(keys))):
            head = 0
            same = np.ones(batch.num_rows, dtype=bool)
            for i, c in enumerate(own):
                same &= c == rest[-1].column(i)[-1].as_py()
            head = int(same.sum())
            yield _one([*rest, batch.slice(0, head)])
            if cut > head:
                yield batch.slice(head, cut - head)
            rest = [batch.slice(max(cut, head))] if max(cut, head) < batch.num_rows else []
        else:
            if cut:
                yield batch.slice(0, cut)
            rest.append(batch.slice(cut))
    if rest:
        yield _one(rest)


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _bounds(batch: pa.RecordBatch, keys: int) -> np.ndarray:
    change = np.zeros(batch.num_rows, dtype=bool)
    for i in range(keys):
        c = batch.column(i).to_numpy(zero_copy_only=False)
        change[1:] |= c[1:] != c[:-1]
    change[0] = True
    return np.append(np.flatnonzero(change), batch.num_rows)


def _count_collisions(batches: Iterator[pa.RecordBatch], need: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Columns: token, i, j, own (the row's block), id (of the cluster), n, sig. Puts out stars of clusters that hold a pair with ``need`` collisions."""
    for batch in _groups(batches, 3):
        at = _bounds(batch, 3)
        i, j, own, ids, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2, 3, 4, 5))
        flat = batch.column(6).flatten().to_numpy(zero_copy_only=False)
        sig = flat.reshape(batch.num_rows, -1)
        forest = Forest()
        sizes = np.diff(at)
        for m in np.unique(sizes[(sizes > 1) & (sizes <= 16)]):  # small lists of one size at a time
            first = at[:-1][sizes == m]
            for x in range(m):
                for y in range(x + 1, m):
                    p, q = first + x, first + y
                    fits = 100 * np.minimum(n[p], n[q]) >= percent * np.maximum(n[p], n[q])
                    fits &= ((i[p] == j[p]) | (own[p] != own[q])) & (ids[p] != ids[q])
                    p, q = p[fits], q[fits]
                    for lo in range(0, len(p), 8192):
                        a, b = p[lo : lo + 8192], q[lo : lo + 8192]
                        hit = (sig[a] == sig[b]).sum(axis=1) >= need
                        for u, v in zip(ids[a[hit]].tolist(), ids[b[hit]].tolist(), strict=True):
                            forest.join(u, v)
        for lo, hi in zip(at[:-1][sizes > 16].tolist(), at[1:][sizes > 16].tolist(), strict=True):
            within = i[lo] == j[lo]
            left = np.arange(lo, hi) if within else lo + np.flatnonzero(own[lo:hi] == i[lo])
            right = left if within else lo + np.flatnonzero(own[lo:hi] == j[lo])
            for a in left.tolist():
                r = right[right > a] if within else right
                r = r[ids[r] != ids[a]]  # skip what one cluster holds already
                fits = r[100 * np.minimum(n[a], n[r]) >= percent * np.maximum(n[a], n[r])]
                for b in fits[(sig[fits] == sig[a]).sum(axis=1) >= need].tolist():
                    forest.join(int(ids[a]), int(ids[b]))
        yield edge_batch(forest.stars())


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Three columns and text. The text becomes its shingle set, as sorted 64-bit hashes."""
    for batch in batches:
        out: list[bytes] = [b""] * batch.num_rows
        for row, h in _shingles(batch.column(3), k):
            out[row] = h.tobytes()
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(out, pa.binary())], names=[*batch.schema.names[:3], "hashes"])


def _confirm_first(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Columns: comp, i, j, id, hashes: blocks of a group, each with the document ``comp``. Puts out its links."""
    for batch in _groups(batches, 3):
        at = _bounds(batch, 3)
        comp, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 3))
        found = []
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            first = np.flatnonzero(ids[lo:hi] == comp[lo])
            if not len(first):
                continue
            own = np.frombuffer(batch.column(4)[lo + int(first[0])].as_buffer(), dtype=np.uint64)
            for r in range(lo, hi):
                if ids[r] != comp[lo]:
                    h = np.frombuffer(batch.column(4)[r].as_buffer(), dtype=np.uint64)
                    i = np.searchsorted(own, h)
                    i[i == len(own)] = 0
                    both = int((own[i] == h).sum())
                    if 100 * both >= percent * (len(own) + len(h) - both):
                        found.append((int(ids[r]), int(comp[lo])))
        yield edge_batch(found)


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Columns: comp, i, j, own, id, hashes. Puts out stars of the links of each block pair, by exact set sizes."""
    for batch in _groups(batches, 3):
        at = _bounds(batch, 3)
        i, j, own, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2, 3, 4))
        forest = Forest()
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if hi - lo < 2:
                continue
            sets = [np.frombuffer(batch.column(5)[r].as_buffer(), dtype=np.uint64) for r in range(lo, hi)]
            within = i[lo] == j[lo]
            left = np.arange(hi - lo) if within else np.flatnonzero(own[lo:hi] == i[lo])
            right = left if within else np.flatnonzero(own[lo:hi] == j[lo])
            if not len(left) or not len(right):
                continue
            size = np.array([len(s) for s in sets])
            both = _common(sets, left, right, size)
            link = 100 * both >= percent * (size[left][:, None] + size[right][None, :] - both)
            if within:
                link &= left[:, None] < right[None, :]
            x, y = np.nonzero(link)
            for u, v in zip(ids[lo + left[x]].tolist(), ids[lo + right[y]].tolist(), strict=True):
                forest.join(u, v)
        yield edge_batch(forest.stars())


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the left with the right sets."""
    if len(left) * len(right) <= 64:
        return np.array([[len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for b in right] for a in left], dtype=np.int64).reshape(len(left), len(right))
    every = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), size)
    _, code, times = np.unique(every, return_inverse=True, return_counts=True)
    shared = times[code] > 1  # the others are in no intersection
    row, code = row[shared], code[shared]
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    new = np.concatenate(([0], np.cumsum(code[1:] != code[:-1]))) if len(code) else code
    lo = 0
    while lo < len(new):
        hi = int(np.searchsorted(new, new[lo] + 4096))
        dense = np.zeros((len(sets), 4096), dtype=np.float32)
        dense[row[lo:hi], new[lo:hi] - new[lo]] = 1
        out += (dense[left] @ dense[right].T).astype(np.int64)
        lo = hi
    return out


def _met(rows: DataFrame, key: str, blocks: str, id_col: str) -> DataFrame:
    """Every row once for each pair of blocks of its group that its block is part of: columns key, i, j, own."""
    own = F.pmod(F.xxhash64(id_col), F.col(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1))
    rest = [c for c in rows.columns if c not in (key, blocks)]
    return rows.withColumn("own", own).withColumn("_o", other).select(key, F.least("own", "_o").alias("i"), F.greatest("own", "_o").alias("j"), "own", *rest)


def _spread(rows: DataFrame, size: float) -> DataFrame:
    keys = rows.columns[:3]
    return rows.repartition(_io.parts_for(rows.sparkSession, size, TASK_BYTES), *keys).sortWithinPartitions(*keys)


def _shared(rows: DataFrame, key: str, id_col: str, **totals) -> DataFrame:
    """rows whose key has more than one, with totals over the key. A key's rows are dealt over SALTS tasks, so one that holds
    a third of all rows is no task of its own: the totals are partial sums first and are sent to the salts that occur."""
    own = rows.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int"))
    salts = F.expr(f"filter(sequence(0, {SALTS - 1}), s -> shiftright(_salts, s) & 1 = 1)")
    sums = own.groupBy(key).agg(F.count("*").alias("_n"), F.expr("bit_or(shiftleft(1L, _salt))").alias("_salts"), *(t.alias(n) for n, t in totals.items())).where("_n > 1")
    return own.join(sums.select(key, *totals, F.explode(salts).alias("_salt")), [key, "_salt"]).drop("_salt")


def _blocks(n) -> Column:
    """Blocks for the members of a group with ``n`` shingles each, null ones left out; one at least."""
    n = F.col(n) if isinstance(n, str) else n
    return F.greatest(F.lit(1), F.ceil(F.count(n) / BLOCK), F.ceil(F.sum(n) / BLOCK_SHINGLES)).cast("int")


def _texts(base: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """ids (comp, id and one more column) with the shingle set of each document, as sorted 64-bit hashes."""
    few = ids.count() <= BROADCAST_IDS
    rows = base.join(F.broadcast(ids) if few else ids, "id").select(*ids.columns, "text")
    schema = _io.schema_with(rows.drop("text"), "hashes binary")
    return rows.transform(_io.arrow(lambda b: _sets(b, shingle), schema))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80, coords: int = COORDS) -> DataFrame:
    """One row per row of docs: id_col, n_shingles, component_id (smallest id reachable by links), kept.

    Words are the lower-cased (A-Z) runs of ``[^\\x20\\x09-\\x0D]``; a text of fewer than ``shingle`` words is one
    shingle. Two documents are linked when 100 * |intersection| >= percent * |union|. A null, empty or blank text has
    no shingle and is linked with nothing. Rows that share an id are one node. A row without an id has a null component
    and is kept. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    with _io.steps(spark):
        need = need_of(percent, coords)
        base = docs.select(docs[f"`{id_col}`"].cast("long").alias("id"), docs[f"`{text}`"].alias("text"))
        sketch = _io.written(base.transform(_io.arrow(lambda b: _sketch(b, shingle, coords), "id long, n long, key binary, sig array<int>")), "sketch")
        own = sketch.where("key is not null and id is not null")
        classes = _io.written(own.groupBy("key").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")), "classes")
        sigs = classes.select("rep", "n", "sig")

        bands = F.array(*(F.xxhash64(F.lit(b), F.slice("sig", b + 1, BAND)) for b in range(0, coords, BAND)))
        stars = _shared(classes.select("rep", F.explode(bands).alias("band")), "band", "rep", top=F.min("rep"))
        quick = components(stars.where("rep <> top").select(F.col("rep").alias("a"), F.col("top").alias("b")).distinct()).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))

        posted = classes.select("rep", F.posexplode("sig").alias("c", "value")).select("rep", (F.shiftleft(F.col("c").cast("long"), 32) + F.col("value").cast("long") + F.lit(1 << 31)).alias("token"))
        rarest = F.array_sort(F.collect_list(F.struct("times", "token")))
        prefix = F.slice("shared", 1, F.lit(1 - need) + F.size("shared"))
        lists = _shared(posted, "token", "rep", times=F.count("*")).groupBy("rep").agg(rarest.alias("shared")).where(F.size("shared") >= need)
        lists = _io.written(lists.select("rep", F.explode(prefix).alias("x")).select("rep", "x.token"), "lists")
        cand = _shared(lists, "token", "rep", blocks=F.ceil(F.count("*") / LIST)).join(sigs, "rep").join(quick, "rep", "left")
        cand = _met(cand.select("token", "blocks", "rep", F.coalesce("cluster", "rep").alias("cluster"), "n", "sig"), "token", "blocks", "rep").drop("rep")
        found = _spread(cand, lists.count() * (4.0 * coords + 64)).transform(_io.arrow(lambda b: _count_collisions(b, need, percent), EDGES))
        near = components(found.union(quick.select(F.col("rep").alias("a"), F.col("cluster").alias("b"))))

        near = near.join(sigs.select(F.col("rep").alias("node"), "n"), "node")
        members = _io.written(_shared(near, "component", "node", blocks=_blocks("n")).select(F.col("component").alias("comp"), "blocks", F.col("node").alias("id"), "n"), "members")
        dealt = F.when(F.col("id") == F.col("comp"), F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).otherwise(F.array(F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
        rows = _texts(base, members.select("comp", "id", dealt.alias("own")), shingle).select("comp", F.explode("own").alias("i"), F.col("i").alias("j"), "id", "hashes")
        size = members.agg(F.sum(8.0 * F.col("n") + 64)).first()[0] or 0
        stars = _io.written(_spread(rows, size).transform(_io.arrow(lambda b: _confirm_first(b, percent), EDGES)), "stars")

        rest = members.join(stars.select(F.col("a").alias("id"), F.lit(True).alias("linked")), "id", "left").withColumn("free", F.col("linked").isNull() & (F.col("id") != F.col("comp")))
        n = lambda c: F.when(c, F.col("n"))
        rest = _shared(rest.select("comp", "id", "n", "free"), "comp", "id", near=_blocks(n(~F.col("free"))), far=_blocks(n(F.col("free"))), left=F.count(n(F.col("free")))).where("left > 0")
        hashed = lambda k: F.pmod(F.xxhash64("id"), F.col(k)).cast("int")
        near, far = F.col("near").cast("int"), F.col("far").cast("int")
        place = F.when(F.col("free"), near + hashed("far")).otherwise(hashed("near"))
        others = F.sequence(F.when(F.col("free"), F.lit(0)).otherwise(near), near + far - 1)
        rest = _io.written(rest.select("comp", "id", "n", F.transform(others, lambda o: F.struct(F.least(place, o).alias("i"), F.greatest(place, o).alias("j"), place.alias("own"))).alias("pairs")), "rest")
        size = rest.agg(F.sum(F.size("pairs") * (8.0 * F.col("n") + 64))).first()[0] or 0
        rows = _texts(base, rest.select("comp", "id", "pairs"), shingle).select("comp", F.explode("pairs").alias("x"), "id", "hashes").select("comp", "x.i", "x.j", "x.own", "id", "hashes")
        links = components(stars.union(_spread(rows, size).transform(_io.arrow(lambda b: _confirm(b, percent), EDGES))))

        # a class of one is its own group unless it is linked; the others find their class by key, dealt over salts
        copies = _shared(own.select("id", "n", "key"), "key", "id", rep=F.min("id")).select("id", "n", "rep")
        alone = own.select("id", "n", "key").join(classes.select(F.col("rep").alias("id"), "key"), ["id", "key"]).select("id", "n", F.col("id").alias("rep"))
        every = copies.where("id <> rep").union(alone)
        every = every.join(links.select(F.col("node").alias("rep"), "component"), "rep", "left").select("id", "n", F.coalesce("component", "rep").alias("component"))
        out = every.union(sketch.where("key is null or id is null").select("id", "n", F.col("id").alias("component")))
        return _io.result(out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept")), "groups")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of docs, with their own columns, that are the smallest id of their group of near-duplicates."""
    gone, own = _io.fresh(docs, "gone"), f"`{id_col}`"
    drop = near_duplicates(docs, id_col, text, **how).where("not kept").select(F.col(own).alias(gone)).distinct()
    return docs.join(drop, docs[own].cast("long") == F.col(gone), "left_anti")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_io.table(spark, sf_dir, "documents"), shingle=3, percent=85)


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
ORACLE = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) >= 3 THEN array_to_string(list_slice(ws, s, s + 2), ' ') ELSE array_to_string(ws, ' ') END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, CAST(greatest(len(ws) - 2, 1) AS BIGINT) + 1)) AS s FROM w WHERE len(ws) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
both_ways AS (SELECT x AS a, y AS b FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT DISTINCT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN comp c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
