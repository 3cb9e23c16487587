"""Exact n-gram Jaccard join by vertical partitioning.

The hashes of a document's distinct shingles have one global order, which is cut into FRAGMENTS equal ranges.

1. Equal sets are one class, named by its smallest id; only class representatives go on.
2. The low half of the order (all of it for small sets) finds candidates.  Two sets of similarity t or more miss at
   most floor((1 - t) n) shingles of each other, so they share a shingle among the floor((1 - t) n) + 1 rarest of the
   part that is looked at.  A shingle that only one set holds can't be shared, so a set with that many is finished
   at once: passages that many documents share don't make pairs of otherwise different documents.
3. Within the documents of such a shingle, first each is paired with one hub, which is linear in the group.  Overlaps
   are counted for each fragment separately and summed for each pair.  Only shingles whose documents are in different
   components after this give further pairs, and of these only pairs that a parity bitmap can't rule out.  Pairs that
   are linked through others anyway are never made, so a group of near copies costs no square of its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickforge.llm.bytesops import map_batches, shingles, slices, utf8, words
from tickforge.llm.components import components
from tickforge.llm.storage import discard, release, settle

FRAGMENTS = 4
#: Sets of at most this size are indexed whole; the low half of a larger one holds over a quarter of it.
SMALL = 256
BITS = 2048
#: Tables of ids are broadcast up to this many rows (about 25 MB as a hashed relation), and joined by a shuffle beyond.
FEW_IDS = 500_000
#: Tokens that are indexed, or counted, at once.
TOKENS = 1 << 18
#: A shingle that more than 1 / FREQUENT of all rows hold is spread over SPREAD groups when shingles are counted.
FREQUENT, SPREAD = 128, 1024
#: Documents of a shingle that one task compares with as many others; larger groups are cut into pairs of such blocks.
GROUP = 1024
_HALF = np.uint64(1 << 63)
_SALT = np.int64(0x5851F42D4C957F2D)


def _bitmap(tokens: np.ndarray) -> bytes:
    """Parity of the set's tokens in BITS cells: two sets differ in at least as many tokens as their bitmaps in bits."""
    return np.packbits(np.bincount((tokens & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS).astype(np.uint8) & 1).tobytes()


class Frequent:
    """Counts of tokens in bounded memory: all that more than a share of the sets hold are among those kept.

    Where too many are held, the rarest go; `missed` is how often, at most, one that went or is held was not counted.
    """

    def __init__(self, most: int = 2 * TOKENS):
        self.most, self.missed, self.sets, self.waiting = most, 0, 0, 0
        self.parts: list[np.ndarray] = []
        self.token, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, tokens: np.ndarray) -> None:
        self.sets += 1
        self.parts.append(tokens)
        self.waiting += len(tokens)
        if self.waiting >= self.most:
            self._merge()

    def _merge(self) -> None:
        token, count = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.parts]), return_counts=True)
        self.parts, self.waiting = [], 0
        every, place = np.unique(np.concatenate([self.token, token]), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate([self.count, count]), minlength=len(every)).astype(np.int64)
        if len(every) > self.most:
            cut = max(1, int(np.partition(total, len(total) // 2)[len(total) // 2]))
            every, total = every[total > cut], total[total > cut]
            self.missed += cut
        self.token, self.count = every, total

    def found(self, share: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens that may be in more than 1 / share of the sets, and their counts."""
        self._merge()
        keep = (self.count + self.missed > self.sets / share) & (self.count > 1)
        return self.token[keep], self.count[keep]


def shingle_sets(df: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, n, f1, f2, half): size, 128-bit digest and count in the low half of each row's set.

    Beside these, shingles that many rows of a partition hold: n is less than 0, how many rows; f1 is the shingle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = Frequent()
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for s in shingles(*words(*utf8(part.column("text"))), width):
                    often.add(s)
                    with np.errstate(over="ignore"):
                        f1 = int(np.sum(s, dtype=np.uint64).astype(np.int64))
                        f2 = int(np.sum((s ^ (s >> np.uint64(29))) * (s | np.uint64(1)), dtype=np.uint64).astype(np.int64))
                    rows.append((len(s), f1, f2, int(np.searchsorted(s, _HALF))))
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([part.column("id"), *[pa.array(c, pa.int64()) for c in columns]], ["id", "n", "f1", "f2", "half"])
        token, count = often.found(2 * FREQUENT)
        for a in range(0, len(token), TOKENS):
            t, c = token[a : a + TOKENS].view(np.int64), count[a : a + TOKENS]
            none = pa.nulls(len(t), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(-c, pa.int64()), pa.array(t, pa.int64()), none, none], ["id", "n", "f1", "f2", "half"])

    return map_batches(_texts(df, id_col, text_col), run, "id long, n long, f1 long, f2 long, half long")


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def _postings(texts: DataFrame, width: int, top: int) -> DataFrame:
    """(token, rec, more): the indexed tokens of each set; those that meet within TOKENS of them are one row, with more ids.

    rec is 2 id for the whole set (up to top) and 2 id + 1 for the low half (above SMALL); tokens of either are kept apart.
    """

    def packed(tokens: list[np.ndarray], recs: list[tuple[int, int]]) -> pa.RecordBatch:
        token = np.concatenate(tokens)
        rec = np.repeat(np.array([r for r, _ in recs], dtype=np.int64), [n for _, n in recs])
        order = np.argsort(token, kind="stable")
        token, rec = token[order], rec[order]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        count = np.diff(np.append(first, len(token)))
        single = count == 1
        loff = np.zeros(len(first) + 1, dtype=np.int32)
        np.cumsum(np.where(single, 0, count), out=loff[1:])
        lists = pa.ListArray.from_arrays(pa.array(loff), pa.array(rec[np.repeat(~single, count)], pa.int64()), mask=pa.array(single))
        return pa.RecordBatch.from_arrays([pa.array(token[first], pa.int64()), pa.array(rec[first], pa.int64(), mask=~single), lists], ["token", "rec", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, recs, held = [], [], 0
            for part in slices(batch, "text"):
                for i, s in zip(part.column("id").to_pylist(), shingles(*words(*utf8(part.column("text"))), width), strict=True):
                    if len(s) <= top:
                        tokens.append(s.view(np.int64) ^ _SALT)
                        recs.append((2 * i, len(s)))
                        held += len(s)
                    if len(s) > SMALL:
                        low = s[: np.searchsorted(s, _HALF)].view(np.int64).copy()
                        tokens.append(low)
                        recs.append((2 * i + 1, len(low)))
                        held += len(low)
                    if held >= TOKENS:
                        yield packed(tokens, recs)
                        tokens, recs, held = [], [], 0
            if held:
                yield packed(tokens, recs)

    return map_batches(texts, run, "token long, rec long, more array<long>")


def _bitmaps(texts: DataFrame, width: int) -> DataFrame:
    """(id, n, bits) of each text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [(len(s), _bitmap(s)) for s in shingles(*words(*utf8(part.column("text"))), width)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([n for n, _ in found], pa.int64()), pa.array([b for _, b in found], pa.binary())], ["id", "n", "bits"])

    return map_batches(texts, run, "id long, n long, bits binary")


def _within(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows (token, p, q, block, rec, n, comp, bits) in order of (token, p, q) -> pairs that may be similar enough.

    A pair is of different components, and of the blocks p and q.
    """
    key, parts = None, []

    def pairs(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows)
        rec, n, comp = (t.column(c).to_numpy() for c in ("rec", "n", "comp"))
        if comp.min() == comp.max():
            return
        order = np.argsort(n, kind="stable")
        rec, n, comp = rec[order], n[order], comp[order]
        block = t.column("block").to_numpy()[order]
        one = t.column("p")[0] == t.column("q")[0]
        bits = np.frombuffer(b"".join(t.column("bits").to_pylist()), dtype=np.uint64).reshape(len(rec), -1)[order]
        step = max(1, (1 << 21) // max(1, bits.shape[1] * len(rec)))
        for a in range(0, len(rec), step):
            b = min(a + step, len(rec))
            end = int(np.searchsorted(n, n[b - 1] * den // num, side="right"))
            if end <= a + 1:
                continue
            far = np.bitwise_count(bits[a:b, None, :] ^ bits[None, a:end, :]).sum(axis=2, dtype=np.int64)
            both = n[a:b, None] + n[None, a:end]
            ok = (far * (den + num) <= both * (den - num)) & (comp[a:b, None] != comp[None, a:end]) & (np.arange(a, b)[:, None] < np.arange(a, end)[None, :])
            if not one:
                ok &= block[a:b, None] != block[None, a:end]
            i, j = np.nonzero(ok)
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(rec[a + i] >> 1, pa.int64()), pa.array(rec[a + j] >> 1, pa.int64())], ["a", "b"])

    for batch in batches:
        values = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("token", "p", "q")], axis=1)
        cuts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1).tolist(), len(values)] if len(values) else []
        for a, b in zip(cuts, cuts[1:], strict=False):
            if parts and tuple(values[a]) != key:
                yield from pairs(parts)
                parts = []
            key = tuple(values[a])
            parts.append(batch.slice(a, b - a))
    if parts:
        yield from pairs(parts)


def small(ids: DataFrame) -> DataFrame:
    """A table of ids, to be broadcast if a count shows that it is small."""
    ids = settle(ids, "ids")
    return F.broadcast(ids) if ids.count() <= FEW_IDS else ids


def _links(pairs: DataFrame, df: DataFrame, id_col: str, text_col: str, width: int, num: int, den: int) -> DataFrame:
    """Of pairs (a, b), those with den * overlap >= num * union; overlaps are counted by fragment and summed."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = (np.arange(1, FRAGMENTS, dtype=np.uint64) * np.uint64((1 << 64) // FRAGMENTS)).astype(np.uint64)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, frag, total, seg = [], [], [], []
                for i, s in zip(part.column("id").to_pylist(), shingles(*words(*utf8(part.column("text"))), width), strict=True):
                    at = [0, *np.searchsorted(s, edges).tolist(), len(s)]
                    for f in range(FRAGMENTS):
                        ids.append(i)
                        frag.append(f)
                        total.append(len(s))
                        seg.append(s[at[f] : at[f + 1]].view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(frag, pa.int32()), pa.array(total, pa.int64()), pa.array(seg, pa.list_(pa.int64()))], ["id", "frag", "n", "seg"])

    hubs, others = (small(pairs.select(F.col(c).alias("id")).distinct()) for c in ("a", "b"))
    ends = small(hubs.union(others).distinct())
    texts = _texts(df, id_col, text_col).join(ends, "id", "left_semi")
    segs = settle(map_batches(texts, cut, "id long, frag int, n long, seg array<long>"), "segments")
    if segs.groupBy("id", "frag").count().where("count > 1").limit(1).count():
        segs = segs.dropDuplicates(["id", "frag"])
    left = segs.join(hubs, "id", "left_semi").select(F.col("id").alias("a"), "frag", F.col("n").alias("na"), F.col("seg").alias("sa"))
    right = segs.join(others, "id", "left_semi").select(F.col("id").alias("b"), "frag", F.col("n").alias("nb"), F.col("seg").alias("sb"))
    parts = pairs.join(right, "b").join(left, ["a", "frag"]).select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("o"))
    over = parts.groupBy("a", "b").agg(F.sum("o").alias("o"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    links = settle(over.where(F.col("o") * den >= (F.col("na") + F.col("nb") - F.col("o")) * num).select("a", "b", F.col("o").alias("overlap")), "links")
    discard(segs)
    return links


def _often(sets: DataFrame) -> DataFrame:
    """(token, many): shingles, as both indexes have them, that over 1 / FREQUENT of all rows hold, by what was counted.

    Each such shingle is in that share of the sets, so there are at most FREQUENT times the mean size of a set.
    """
    rows = sets.where("n >= 0").count()
    seen = sets.where("n < 0").groupBy("f1").agg(F.sum(-F.col("n")).alias("many")).where(F.col("many") > rows / FREQUENT)
    other = F.col("f1").bitwiseXOR(F.lit(int(_SALT)).cast("long"))
    return small(seen.select(F.explode(F.array("f1", other)).alias("token"), "many").groupBy("token").agg(F.max("many").alias("many")))


def _live(texts: DataFrame, full: DataFrame, often: DataFrame, members: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(rec, n, odd, t): of each set that may have a partner, the rarest shingles t by which it is found.

    odd is its share of shingles that no other set holds, in thousandths.  Frequent shingles are known beforehand, with
    their counts, so their documents need not meet; any one order of the shingles serves, if all sets keep to it.
    """
    miss = F.floor(F.col("n") * (den - num) / den).cast("long")
    # the low half must reach beyond what may miss; sets in which chance has it otherwise, and all that may be like them, are indexed whole
    weak = full.where((F.col("n") > SMALL) & (F.col("half") <= miss)).agg(F.max("n")).first()[0] or 0
    top = max(SMALL, weak) * den // num
    copies = small(members.where("id <> class_id").select("id").distinct())
    kept = full.join(copies, "id", "left_anti")
    posted = F.when(F.col("more").isNull(), 1).otherwise(F.size("more"))
    posts = _postings(texts.join(copies, "id", "left_anti"), width, top).join(often, "token", "left")
    posts = posts.withColumn("salt", F.when(F.col("many").isNull(), 0).otherwise(F.pmod(F.xxhash64(F.coalesce("rec", F.get("more", F.lit(0)))), F.lit(SPREAD))).cast("int"))
    met = posts.withColumn("df", F.coalesce("many", F.sum(posted).over(Window.partitionBy("token", "salt")))).where("df > 1")
    met = met.select("token", "df", F.explode(F.when(F.col("more").isNull(), F.array("rec")).otherwise(F.col("more"))).alias("rec"))
    shared = met.groupBy("rec").agg(F.collect_set(F.struct("df", "token")).alias("t"))
    whole = kept.where(f"n <= {top}").select((F.col("id") * 2).alias("rec"), "n", F.col("n").alias("have"))
    low = kept.where(f"n > {SMALL}").select((F.col("id") * 2 + 1).alias("rec"), "n", F.col("half").alias("have"))
    own = F.col("have") - F.size("t")
    prefix = shared.join(whole.unionByName(low).distinct(), "rec").withColumn("own", own).withColumn("take", (miss + 1 - F.col("own")).cast("int")).where("take > 0")
    first = F.transform(F.slice(F.sort_array("t"), F.lit(1), F.col("take")), lambda x: x["token"])
    return settle(prefix.select("rec", "n", (F.col("own") * 1000 / F.col("have")).cast("long").alias("odd"), first.alias("t")), "live")


def _more(df: DataFrame, live: DataFrame, stars: DataFrame, comp: DataFrame, id_col: str, text_col: str, width: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b) that share such a shingle, are in different components so far, and that no bitmap rules out."""
    tagged = live.withColumn("id", F.shiftright("rec", 1)).join(comp.withColumnRenamed("component", "comp"), "id", "left").select("rec", "id", "n", F.coalesce("comp", "id").alias("comp"), "t")
    rows = tagged.select("rec", "comp", F.explode("t").alias("token"))
    open_ = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.ceil(F.count("*") / GROUP).cast("int").alias("blocks")).where("lo < hi").select("token", "blocks")
    rest = settle(rows.join(settle(open_, "open"), "token").select("token", "rec", "blocks"), "rest")
    ids = small(rest.select(F.shiftright("rec", 1).alias("id")).distinct())
    bits = settle(_bitmaps(_texts(df, id_col, text_col).join(ids, "id", "left_semi"), width).dropDuplicates(["id", "n"]), "bitmaps")
    rest = rest.join(tagged.select("rec", "id", "n", "comp").distinct(), "rec").join(bits, ["id", "n"]).withColumn("block", F.pmod(F.xxhash64("rec"), F.col("blocks")).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("token", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "rec", "n", "comp", "bits")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = map_batches(rest.repartition(parts, "token", "p", "q").sortWithinPartitions("token", "p", "q"), lambda it: _within(it, num, den), "a long, b long").distinct()
    known = stars.select("a", "b").union(stars.select("b", "a"))
    return settle(pairs.join(known, ["a", "b"], "left_anti"), "more")


def jaccard_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, num: int = 75, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """Return (documents, links).

    documents: one row per input row: id, n_shingles, class_id (smallest id with an equal set), component_id
    (smallest id reachable by links of num/den Jaccard similarity or more; an equal non-empty set is a link).
    links: (a, b, overlap) between class representatives, enough of them to connect every component; each is
    verified.  Words are [^\\x20\\x09-\\x0D]+ with A-Z lower-cased; a text shorter than width words is one shingle.

    Nulls: a null text or id: an empty set, linked with nothing; a null id keeps a null class and component.
    Empty texts: the same.  Repeated rows (equal id and text) give equal rows.  Empty tables give empty tables; other columns are ignored, whatever their names.
    Ids must lie between -2^62 and 2^62; an id stands for one text (rows that share an id but not a text are joined
    through that id).  The threshold must be 0.7 or more, so that the low half of a set reaches beyond what may miss.
    """
    spark = df.sparkSession
    sets = settle(shingle_sets(df, id_col, text_col, width), "sets")
    full = sets.where("n > 0 and id is not null")
    classes = settle(full.groupBy("f1", "f2", "n").agg(F.min("id").alias("class_id")), "classes")  # as a table, so that a join with a hot class can be split
    members = settle(full.select("id", "n", "f1", "f2").join(classes, ["f1", "f2", "n"]).select("id", "n", "class_id").distinct(), "members")
    live = _live(_texts(df, id_col, text_col).where("id is not null"), full, _often(sets), members, width, num, den)
    release(spark)

    rows = live.select("rec", "n", "odd", F.explode("t").alias("token"))
    hubs = settle(rows.groupBy("token").agg(F.min(F.struct("odd", "rec", "n")).alias("hub"), F.count("*").alias("g")).where("g > 1"), "hubs")
    near = (F.col("n") * den >= F.col("hub.n") * num) & (F.col("hub.n") * den >= F.col("n") * num)
    stars = rows.join(hubs, "token").where(near & (F.col("rec") != F.col("hub.rec")))
    stars = settle(stars.select(F.shiftright("hub.rec", 1).alias("a"), F.shiftright("rec", 1).alias("b")).where("a <> b").distinct(), "stars")
    links = _links(stars, df, id_col, text_col, width, num, den)
    release(spark)

    more = _more(df, live, stars, components(links), id_col, text_col, width, num, den)
    links = settle(links.unionByName(_links(more, df, id_col, text_col, width, num, den)), "all-links")

    comp = components(links)
    found = members.join(comp.select(F.col("id").alias("class_id"), F.col("component").alias("c")), "class_id", "left").select("id", "n", "class_id", F.coalesce("c", "class_id").alias("component_id"))
    docs = sets.where("n >= 0").select("id", "n").join(found.withColumnRenamed("n", "m").withColumnRenamed("id", "i"), (F.col("id") == F.col("i")) & (F.col("n") == F.col("m")), "left")
    docs = docs.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("component_id", "id").alias("component_id"))
    return docs, links
