"""N-gram Jaccard join with set-relation skipping.

Documents are sets of word n-grams (64-bit hashes); two link when their
Jaccard similarity reaches ``percent``/100.  The join is exact and never
lists the pairs of a group.

1. Index lists by position.  Linked sets x, y differ in at most
   d = (100 - p) / (100 + p) * (|x| + |y|) n-grams.  A set is dealt by n-gram
   hash onto more than d positions, so linked sets agree wholly in at least
   one; what a position holds is one key of the index.  Lists hold only sets
   of one size class, or of two neighbouring ones; the index blocks of other
   sizes are skipped.  Light positions are left out as keys as far as a set
   still has more than d heavier ones: then one of those it shares with any
   linked set is among them, and that one is as heavy for the other set.
   A position holds several n-grams: unlike single n-grams, it does not join
   texts that merely share a passage.
2. Linked sets share at least (own keys - d) keys of the one with heavier
   keys: what it agrees in is heavy enough for both, while keys of the other
   may be too light here.  A set that meets others on fewer of its keys than
   that links with none: it leaves the lists before any pair is made, and what
   that takes from the others is looked at once more.  Short lists give the
   pairs of their sets, which are counted and dropped below that number.
   Long lists (common to many sets) give no pairs, so no list gives more than
   a few per entry: what a set has on long lists is taken off the number that
   it must share on short ones.  Only sets of which nothing is left then are
   united by the long lists they are on, without counting; a list that then
   lies in one group gives no pairs.  Sets that already
   share enough within a task's gathering are put under one of them before
   the shuffle, so a list that a third of all documents are on arrives as few
   rows.
3. Components of these pairs and stars are families: linked sets are in one family.
   Families of more sets than a block are dealt once more, onto FINE times as
   many positions as n-grams: keys are mostly single n-grams there, and only
   sets most of whose n-grams are common in the family have nothing left to
   share on short lists.  Each family is cut by size class (a set goes to its own class and, as a
   guest, to the next), classes into blocks of bounded size, and pairs of
   blocks are the tasks: sizes that cannot link do not meet.
4. Within a pair of blocks answers are derived, not counted anew: against a
   reference set r (the n-grams most members have), each member is what it
   lacks and what it adds, and
       |x & y| = |r| - |lacks x| - |lacks y| + |lacks x & lacks y| + |adds x & adds y|,
   so one sparse product over the differences answers all pairs.  What
   leaves the task is a spanning star per linked group, not the pairs.
5. Components of those stars are the classes.

Defined cases: null or wordless texts have the empty set and link with
nothing; texts with fewer than n words are one n-gram, the whole sequence;
equal sets link; a null id takes part, the class id is the smallest id that
is not null; repeated rows are in one class, each with its own row; an empty
table gives no rows; other columns are ignored (``keep_one`` carries them).
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokloom.llm.common import (KNOWN_WORDS, documents, give_back, join_by_size, one_by_one, row_key,
                                staged)
from tokloom.llm.components import connected_components

#: Spare positions where only light keys will do.
SPARE = 2
#: Positions a n-gram of the second dealing.
FINE = 4
#: A block holds about so many sets, and so many n-grams in all.
BLOCK_SETS, BLOCK_GRAMS = 512, 1 << 20

_M1, _M2, _M3 = (np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of words; words met before are looked up in a bounded
    table."""

    def __init__(self):
        import xxhash
        self.digest, self.known = xxhash.xxh3_64_intdigest, {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII case and white space only
        known, digest = self.known, self.digest
        if len(known) > KNOWN_WORDS:
            known.clear()
        out = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = digest(w)
            out.append(h)
        return np.array(out, dtype=np.uint64)


def gram_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-gram hashes of a word sequence."""
    if not len(words):
        return words
    width = min(n, len(words))
    grams = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        grams = _mix(grams * _M1 + words[i:len(words) - width + 1 + i] * _M2 + _M3)
    return np.unique(grams)


def set_digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


#: Low bits of a coded need: one plus the weight of the keys, LOWERED plus it
#: where that is below the index's usual one, 0 for sets of several weights.
WEIGHT_BITS, LOWERED = 3, 5
_WEIGHT = (1 << WEIGHT_BITS) - 1
#: Low bits of a key: its index.
INDEX_BITS = 8
_INDEX = (1 << INDEX_BITS) - 1


def pair_need(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Keys that linked sets share at least, from their coded needs: as many
    as either asks for when keys weigh the same; else only the heavier one's
    number holds, and the smaller number in any case."""
    same = ((a & _WEIGHT) == (b & _WEIGHT)) & ((a & _WEIGHT) > 0)
    x, y = a >> WEIGHT_BITS, b >> WEIGHT_BITS
    return np.where(same, np.maximum(x, y), np.minimum(x, y))


def _share(mean: float, weight: int) -> float:
    """Share of positions with ``weight`` n-grams or more, at that mean."""
    return 1 - sum(math.exp(-mean) * mean ** k / math.factorial(k) for k in range(weight))


class Positions:
    """The index keys of a set, for one percentage; with ``fine``, on so many
    positions a n-gram.

    Sizes fall into classes such that linked sets lie in the same class or in
    neighbouring ones; each pair of classes has an index of its own, with its
    own number of positions."""

    def __init__(self, percent: int, fine: int = 0):
        self.percent, self.fine, self.edges, self._plans = percent, fine, [1], {}

    def size_class(self, n: int) -> int:
        while self.edges[-1] <= n:
            low = self.edges[-1]
            self.edges.append(max(low + 1, low * 100 // self.percent + 1))
        return int(np.searchsorted(self.edges, n, side="right")) - 1

    def plan(self, low: int, high: int) -> tuple[int, int, int] | None:
        """For sets of two classes: (most n-grams in which linked ones differ,
        positions, least n-grams of a position that is a key); None when no
        sizes of the two can link.

        A position of one n-gram is a weak key, it joins all texts that share
        that n-gram.  So heavier positions are preferred where even the
        smallest sets of the class have more of them, by the Poisson law with
        some margin, than linked sets can differ in.  The margin also keeps
        empty positions, which join everything, from being keys."""
        if (low, high) not in self._plans:
            self.size_class(self.edges[high])
            top_low, top_high = self.edges[low + 1] - 1, self.edges[high + 1] - 1
            d = (100 - self.percent) * (top_low + top_high) // (100 + self.percent)
            found = (d, d + 1 + SPARE, 1) if d else (0, 1, 1)
            if self.fine:
                found = (d, max(d + 1, self.fine * top_high), 1)
            for weight, percent in ((w, t) for w in (3, 2, 1) for t in range(102, 162, 3) if not self.fine):
                n = -(-(d + 1) * percent // 100)
                share = _share(self.edges[low] / n, weight)
                if n * share - 1.5 * math.sqrt(n * share * (1 - share)) > d:
                    found = (d, n, weight)
                    break
            linkable = top_low * 100 >= self.percent * self.edges[high]
            self._plans[low, high] = found if linkable else None
        return self._plans[low, high]

    def keys(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, for each key how many of that index's keys a linked set must
        share, if its own are not heavier)."""
        key, code = self.coded_keys(grams)
        return key, code >> WEIGHT_BITS

    def coded_keys(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, for each key that number above WEIGHT_BITS bits that tell
        the least n-grams of a key)."""
        own = self.size_class(len(grams))
        self.size_class(self.edges[own + 1])
        mixed = _mix(grams + _M3)
        found, need = [], []
        for low, high in ((own, own), (own, own + 1), (own - 1, own)):
            plan = self.plan(low, high) if low >= 0 else None
            if not plan:
                continue
            d, n, usual = plan
            weight = usual
            place = ((grams >> np.uint64(32)) % np.uint64(n)).astype(np.int64)
            content = np.zeros(n, dtype=np.uint64)
            np.add.at(content, place, mixed)
            load = np.bincount(place, minlength=n)
            at = np.flatnonzero(load >= weight)
            while len(at) <= d and weight:  # else linked sets might agree in lighter ones only
                weight -= 1
                at = np.flatnonzero(load >= weight)
            number = (low + 1) * 2 + (high > low)
            index = number * int(_M2) & 0xFFFFFFFFFFFFFFFF
            key = _mix(content[at] + at.astype(np.uint64) * _M1 + np.uint64(index))
            found.append(key & np.uint64(~_INDEX & 0xFFFFFFFFFFFFFFFF) | np.uint64(number & _INDEX))
            need.append(np.full(len(at), (len(at) - d) << WEIGHT_BITS
                                | (weight + (1 if weight == usual else LOWERED))))
        return np.concatenate(found), np.concatenate(need)


DOC = "struct<doc_id:long,rkey:string,n:long,cls:binary>"
#: Index rows have a key, a set number and its coded need, document rows the
#: other two.
INDEX = f"key long, set long, need int, doc {DOC}"
#: Two sets and the keys they share, and the keys that linked ones share; need
#: 0: they are one family in any case, or, where a is negative, a long list and
#: a set on it, n its coded need.
SHARED = "a long, b long, n int, need int"
#: Lists up to this length give the pairs of their sets.
SHORT_LIST = 16
#: How often sets that meet others on too few keys leave the lists.
ROUNDS = 2

_DOC_TYPE = pa.struct([("doc_id", pa.int64()), ("rkey", pa.string()), ("n", pa.int64()),
                       ("cls", pa.binary())])


#: Documents decoded, and index keys gathered, at a time in a task.
DECODE_ROWS, GATHER_KEYS = 500, 150_000


def _index_batches(batches, n: int, percent: int, fine: int = 0):
    """A row per document, and the index rows of its set.  Keys are gathered
    up to a bound and combined before they leave the task; a set met again
    while its keys are held adds none.  Sets are numbered by task and place:
    small differences between rows, which shuffle files compress; equal sets
    of different gatherings meet in the index."""
    from pyspark import TaskContext
    hasher, positions = WordHasher(), Positions(percent, fine)
    number = TaskContext.get().partitionId() << 40
    seen, held, n_held = {}, [], 0
    for batch in batches:
        for low in range(0, batch.num_rows, DECODE_ROWS):
            part = batch.slice(low, DECODE_ROWS)
            sets, docs = [], []
            for doc, rkey, text in zip(*(one_by_one(part.column(c)) for c in ("doc_id", "rkey", "text"))):
                grams = gram_set(hasher(text or ""), n)
                cls = set_digest(grams)
                if cls not in seen:
                    seen[cls] = number
                    if len(grams):
                        key, need = positions.coded_keys(grams)
                        held.append((key.view(np.int64), np.full(len(key), number), need))
                        n_held += len(key)
                    number += 1
                sets.append(seen[cls])
                docs.append({"doc_id": doc, "rkey": rkey, "n": len(grams), "cls": cls})
                if n_held >= GATHER_KEYS:
                    yield from _combined(*map(np.concatenate, zip(*held)))
                    seen, held, n_held = {}, [], 0
            yield _rows(pa.nulls(len(sets), pa.int64()), pa.array(sets, pa.int64()),
                        pa.nulls(len(sets), pa.int32()), pa.array(docs, _DOC_TYPE))
    if held:
        yield from _combined(*map(np.concatenate, zip(*held)))
    del seen, held, hasher
    give_back()


def _pair_counts(a, b, need):
    """Distinct pairs (a, b), how often they occur, the least need of each."""
    order = np.lexsort((b, a))
    a, b, need = a[order], b[order], need[order]
    first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    return a[first], b[first], np.diff(np.append(first, len(a))), np.minimum.reduceat(need, first)


def _combined(key, owner, need):
    """Index rows of one gathering.  A set that shares as many keys with the
    first set of its lists as linked sets must is put under it: those keys
    travel once, with the least need of the two and their weight if it is
    one, and the pair as a list of its own that asks for nothing more."""
    order = np.lexsort((owner, key))
    key, owner, need = key[order], owner[order], need[order]
    first = np.append(True, key[1:] != key[:-1])
    at = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
    other = np.flatnonzero(~first)
    if len(other):
        both = pair_need(need[other], need[at[other]])
        a, b, count, least = _pair_counts(owner[at[other]], owner[other], both)
        one = count >= least
        a, b = a[one], b[one]
        code = _mix(a.view(np.uint64) * _M1 + b.view(np.uint64))
        under = np.isin(_mix(owner[at[other]].view(np.uint64) * _M1 + owner[other].view(np.uint64)), code)
        head, low = at[other[under]], need[other[under]]
        mixed = head[(need[head] & _WEIGHT) != (low & _WEIGHT)]
        least = need >> WEIGHT_BITS
        np.minimum.at(least, head, low >> WEIGHT_BITS)
        need = least << WEIGHT_BITS | (need & _WEIGHT)
        need[mixed] &= ~_WEIGHT
        keep = np.ones(len(key), dtype=bool)
        keep[other[under]] = False
        key, owner, need = key[keep], owner[keep], need[keep]
        own = code.view(np.int64)
        yield _index_rows(np.concatenate([own, own]), np.concatenate([a, b]), np.zeros(2 * len(a), np.int64))
    yield _index_rows(key, owner, need)


def _rows(*columns, names=("key", "set", "need", "doc")) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=list(names))


def _index_rows(key, owner, need) -> pa.RecordBatch:
    return _rows(pa.array(key), pa.array(owner), pa.array(need, pa.int32()), pa.nulls(len(key), _DOC_TYPE))


def _met_rows(batches):
    """Index rows in key order -> those of lists that have other rows; document
    rows pass through.  The last row of a batch waits for the next."""
    last, met_before = None, False
    for batch in batches:
        table = pa.Table.from_batches([batch])
        is_doc = table.column("key").is_null()
        yield from table.filter(is_doc).to_batches()
        rows = table.filter(pc.invert(is_doc))
        if not len(rows):
            continue
        now = [rows.column(c).to_numpy().astype(np.int64) for c in ("key", "set", "need")]
        if last:
            now = [np.concatenate(x) for x in zip(last, now)]
        same = now[0][1:] == now[0][:-1]
        met = np.append(met_before, same) | np.append(same, False)
        yield _index_rows(*(x[:-1][met[:-1]] for x in now))
        last, met_before = [x[-1:] for x in now], bool(met[-1])
    if met_before:
        yield _index_rows(*last)


def _read_lists(batches):
    """Index rows in key order -> shared keys of pairs of sets, and the rows
    of long lists (``_families`` hands on none).  The rows of the last list of a
    batch wait for the next."""
    names = ("a", "b", "n", "need")

    def shared(key, owner, need):
        size = np.diff(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])))
        many = np.repeat(size, size) > SHORT_LIST
        if many.any():
            yield _rows(pa.array(-(key[many] & np.int64(2**63 - 1)) - 1), pa.array(owner[many]),
                        pa.array(need[many], pa.int32()), pa.array(np.zeros(int(many.sum()), np.int32)), names=names)
        key, owner, need = key[~many], owner[~many], need[~many]
        found = []
        for step in range(1, SHORT_LIST):
            i = np.flatnonzero((key[step:] == key[:-step]) & (owner[step:] != owner[:-step]))
            if not len(i):
                break
            found.append((owner[i], owner[i + step], pair_need(need[i], need[i + step])))
        if found:
            a, b, need = map(np.concatenate, zip(*found))
            a, b, count, need = _pair_counts(np.minimum(a, b), np.maximum(a, b), need)
            yield _rows(pa.array(a), pa.array(b), pa.array(count, pa.int32()), pa.array(need, pa.int32()),
                        names=names)

    waiting = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(c).to_numpy().astype(np.int64) for c in ("key", "set", "need")]
        if waiting:
            now = [np.concatenate(x) for x in zip(waiting, now)]
        last = int(np.searchsorted(now[0], now[0][-1]))
        if last:
            yield from shared(*(x[:last] for x in now))
        waiting = [x[last:] for x in now]
        if len(waiting[0]) > 64 * SHORT_LIST:  # a long list, also what comes of it: its head stays
            yield from shared(*waiting)
            waiting = [x[:SHORT_LIST + 1] for x in waiting]
    if waiting:
        yield from shared(*waiting)


def linked_overlap(n_x, n_y, overlap, percent: int):
    return 100 * overlap >= percent * (n_x + n_y - overlap)


def block_links(sets: list[np.ndarray], percent: int, columns: int = 4096) -> list[tuple[int, int]]:
    """Stars (first, other) over the linked groups among the given distinct
    sets, by differences to a reference set."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    if m == 2:
        o = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if linked_overlap(*sizes, o, percent) else []
    grams, where, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(m), sizes)
    common = count * 2 > m
    # lacks: members without a common n-gram; adds: members with another one
    n_common = int(common.sum())
    has = np.bincount(rows[common[where]], minlength=m)
    lacks = n_common - has
    overlap = n_common - lacks[:, None] - lacks[None, :]
    shared = (count > 1) & ~(common & (count == m))
    place = np.cumsum(shared) - 1
    total = int(shared.sum())
    use = shared[where]
    r, c, flip = rows[use], place[where[use]], common[shared]
    order = np.argsort(c, kind="stable")
    r, c = r[order], c[order]
    for low in range(0, total, columns):
        high = min(total, low + columns)
        a, b = np.searchsorted(c, (low, high))
        x = np.zeros((m, high - low), dtype=np.float32)
        x[r[a:b], c[a:b] - low] = 1
        x[:, flip[low:high]] = 1 - x[:, flip[low:high]]
        overlap += (x @ x.T).astype(np.int64)  # at most ``columns`` each: whole in single precision
    near = linked_overlap(sizes[:, None], sizes[None, :], overlap, percent)
    group = np.full(m, -1)
    stars = []
    for i in range(m):
        if group[i] >= 0:
            continue
        group[i], front = i, np.array([i])
        while len(front):
            reach = near[front].any(axis=0) & (group < 0)
            front = np.flatnonzero(reach)
            group[front] = i
        stars += [(i, j) for j in np.flatnonzero(group == i) if j != i]
    return stars


def _verify(batches, percent: int):
    """Rows (family, c, b1, b2, cls, grams) in that order -> stars between
    sets; one pair of blocks is held at a time."""
    current, held = None, {}

    def links():
        names = sorted(held, key=lambda c: (len(held[c]), c))
        sets = [np.frombuffer(held[c], dtype=np.uint64) for c in names]
        if not _any_compatible(sets, percent):
            return []
        return [(names[i], names[j]) for i, j in block_links(sets, percent)]

    for batch in batches:
        out = []
        for *task, cls, grams in zip(*(one_by_one(batch.column(i)) for i in range(6))):
            if task != current:
                if held:
                    out += links()
                current, held = task, {}
            held[cls] = grams
        yield _star_rows(out)
    if held:
        yield _star_rows(links())
    held = {}
    give_back()


def _any_compatible(sets: list[np.ndarray], percent: int) -> bool:
    """Whether some two sizes, sorted here, allow a link at all."""
    n = [len(s) for s in sets]
    return any(100 * a >= percent * b for a, b in zip(n, n[1:]))


def _star_rows(pairs) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())],
                                      names=["a", "b"])


def ngram_classes(df: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """Staged table, one row per row of ``df`` (doc_id, text): doc_id, rkey
    (content key of the row), n_shingles, cls (the set) and root (the set
    that stands for its linked class)."""
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"),
                     row_key(F.col("doc_id"), F.col("text")).alias("rkey"), "text")
    docs, families = _indexed(rows, n, percent)

    # one text per set of a family of at least two sets; the sets of a family
    # are counted after equal ones of different batches have met
    holders = staged(docs.where("n > 0").join(families, "v").groupBy("cls", F.col("root").alias("family"))
                     .agg(F.min("rkey").alias("rkey"), F.first("n").alias("n")), "holders")
    large = staged(holders.groupBy("family").count().where(F.col("count") > BLOCK_SETS).select("family"), "large")
    if not large.isEmpty():
        holders = staged(_dealt_again(rows, holders, large, n, percent), "holders")
    positions = Positions(percent)
    positions.size_class(holders.agg(F.max("n")).first()[0] or 1)
    edges = F.array(*[F.lit(e) for e in positions.edges])  # about a hundred
    own = F.size(F.filter(edges, lambda e: e <= F.col("n")))
    placed = holders.select("rkey", "family", "n", F.explode(F.array(own, own + 1)).alias("c"))
    sizes = placed.groupBy("family", "c").agg(F.count("*").alias("sets"), F.sum("n").alias("grams"))
    sizes = staged(sizes.where("sets > 1").select("family", "c", F.greatest(
        F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("grams") / BLOCK_GRAMS))
        .cast("int").alias("blocks")), "sizes")
    block = F.pmod(F.xxhash64("rkey"), F.col("blocks")).cast("int")
    dealt = staged(placed.join(sizes, ["family", "c"]).groupBy("rkey", "family").agg(
        F.collect_list(F.struct("c", "blocks", block.alias("b"))).alias("places")), "dealt")
    texts = join_by_size(rows.select("rkey", "text"), dealt, "rkey")

    def grams(batches):
        hasher = WordHasher()
        for batch in batches:
            for low in range(0, batch.num_rows, DECODE_ROWS):
                part = batch.slice(low, DECODE_ROWS)
                sets = [gram_set(hasher(t or ""), n) for t in one_by_one(part.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("family"), part.column("places"),
                     pa.array([set_digest(s) for s in sets], pa.binary()),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["family", "places", "cls", "grams"])
        hasher.known.clear()
        give_back()

    sets = texts.select("family", "places", "text").mapInArrow(
        grams, "family long, places array<struct<c:int,blocks:int,b:int>>, cls binary, grams binary")
    sets = sets.select("family", F.explode("places").alias("p"), "cls", "grams")
    pairs = sets.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("p.blocks") - 1))).select(
        "family", "p.c", F.least("p.b", "o").alias("b1"), F.greatest("p.b", "o").alias("b2"), "cls", "grams")
    tasks = (pairs.repartition("family", "c", "b1", "b2")
             .sortWithinPartitions("family", "c", "b1", "b2"))
    links = tasks.mapInArrow(lambda b: _verify(b, percent), "a binary, b binary")
    classes = connected_components(staged(links, "links")).select(
        F.col("v").alias("cls"), F.col("root"))
    return staged(docs.drop("v").join(classes, "cls", "left").select(
        "doc_id", "rkey", F.col("n").alias("n_shingles"), "cls",
        F.coalesce("root", "cls").alias("root")), "classes")


def _indexed(rows: DataFrame, n: int, percent: int, fine: int = 0) -> tuple[DataFrame, DataFrame]:
    """The sets of the rows (v, doc_id, rkey, n, cls) and their families
    (v, root)."""
    index = rows.mapInArrow(lambda b: _index_batches(b, n, percent, fine), INDEX)
    lists = index.repartition(F.coalesce(F.col("key"), F.xxhash64("doc.rkey"))).sortWithinPartitions("key")
    met = staged(lists.mapInArrow(_met_rows, INDEX), "lists")
    docs = met.where("doc is not null").select(F.col("set").alias("v"), "doc.*")
    return docs, _families(met.where("doc is null").drop("doc"))


def _dealt_again(rows: DataFrame, holders: DataFrame, large: DataFrame, n: int, percent: int) -> DataFrame:
    """``holders`` with the ``large`` families cut into those that a second
    index of their sets finds."""
    again = staged(holders.join(large, "family", "left_semi"), "again")
    texts = join_by_size(rows, again.select("rkey"), "rkey", "left_semi").select("doc_id", "rkey", "text")
    docs, families = _indexed(texts, n, percent, FINE)
    part = docs.join(families, "v").groupBy("cls").agg(F.min("root").alias("part"))
    cut = again.join(part, "cls").withColumn("family", F.xxhash64("family", "part")).drop("part")
    return holders.join(large, "family", "left_anti").unionByName(cut.select(*holders.columns))


def _families(lists: DataFrame) -> DataFrame:
    """(v, root) from the index rows (key, set, need): sets put under one
    another are united first, and the groups so found take the places of their
    sets on the lists.  Groups that may link nothing leave the lists; between
    the others the shared keys are added up, and groups unite that share as
    many as linked sets in them must.

    Long lists are not counted.  Of what linked sets share, each has at most
    those keys on long lists that its group has there, so the others must
    still be shared on short lists.  Groups that may share nothing else are
    united by the long lists; so are those with lighter keys than usual, for
    which heavier ones alone tell what must be shared."""
    sure = lists.where("need = 0").groupBy("key").agg(F.min("set").alias("a"), F.max("set").alias("b")).select("a", "b")
    roots = staged(connected_components(sure), "groups").select(F.col("v").alias("set"), "root")
    least, weight = F.shiftright("need", WEIGHT_BITS), F.col("need").bitwiseAND(F.lit(_WEIGHT))
    free = (F.col("weight") == 0) | (F.col("weight") >= LOWERED)
    index = F.col("key").bitwiseAND(F.lit(_INDEX)).alias("index")
    rows = lists.where("need > 0").select("key", "set", least.alias("least"), weight.alias("weight"), index)
    # the first round adds up what the sets of a group meet, so only rows that stay are joined
    met = (rows.groupBy("set", "index").agg(F.count("*").alias("met"), F.min("least").alias("least"), F.max(free).alias("free"))
           .join(roots, "set", "left").withColumn("root", F.coalesce("root", "set")))
    met = staged(met, "met")
    enough = met.groupBy("root", "index").agg(
        F.sum("met").alias("met"), F.min("least").alias("least"), F.max("free").alias("free")).where("free or least <= met")
    stays = met.select("set", "index", "root").join(enough.select("root", "index"), ["root", "index"], "left_semi")
    on = (rows.join(stays, ["set", "index"]).groupBy("key", "index", F.col("root").alias("set"))
          .agg(F.min("least").alias("least"), F.min("weight").alias("weight"), F.max("weight").alias("_top")))
    on = on.withColumn("weight", F.when(F.col("weight") == F.col("_top"), F.col("weight")).otherwise(0)).drop("_top")
    for _ in range(ROUNDS - 1):
        on = _lists_of_several(on)
        linkable = on.groupBy("set", "index").agg(
            F.count("*").alias("met"), F.min("least").alias("least"), F.max(free).alias("free"))
        on = staged(on.join(linkable.where("free or least <= met").select("set", "index"), ["set", "index"], "left_semi")
                    .drop("sets"), "linkable")
    on = staged(_lists_of_several(on), "several")

    long = on.where(F.col("sets") > SHORT_LIST)
    held = staged(long.groupBy("set", "index").agg(F.count("*").alias("held")), "held")
    spent = staged(long.join(held, ["set", "index"]).where(free | (F.col("least") <= F.col("held"))).select(
        (-F.col("key").bitwiseAND(F.lit(2**63 - 1)) - 1).alias("a"), F.col("set").alias("b")), "spent")
    united = connected_components(spent).select(F.col("v").alias("set"), "root")
    short = on.where(F.col("sets") <= SHORT_LIST)
    across = (short.join(united, "set", "left").withColumn("root", F.coalesce("root", "set"))
              .groupBy("key").agg(F.min("root").alias("_low"), F.max("root").alias("_top"))
              .where("_low <> _top").select("key"))
    short = short.join(across, "key", "left_semi").select(
        "key", "set", (F.shiftleft("least", WEIGHT_BITS) + F.col("weight")).alias("need"))
    pairs = short.repartition("key").sortWithinPartitions("key", "set").mapInArrow(_read_lists, SHARED)
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("n"), F.min("need").alias("need"))
    most = held.groupBy("set").agg(F.max("held").alias("held"))
    for end in ("a", "b"):
        counts = counts.join(most.select(F.col("set").alias(end), F.col("held").alias(f"_{end}")), end, "left")
    counts = counts.where(F.col("n") >= F.col("need") - F.least(
        F.coalesce("_a", F.lit(0)), F.coalesce("_b", F.lit(0))))
    return connected_components(sure.union(counts.select("a", "b")).union(spent)).where("v >= 0")


def _lists_of_several(on: DataFrame) -> DataFrame:
    """The rows of lists that several sets are on, with their number."""
    sets = on.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1")
    return on.join(sets, "key")


def ngram_components(df: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked id) of every row."""
    rows = ngram_classes(df, n, percent)
    ids = staged(rows.where("n_shingles > 0").groupBy("root").agg(
        F.min("doc_id").alias("component_id")), "components")
    empty = rows.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return rows.where("n_shingles > 0").join(ids, "root").select(
        "doc_id", "n_shingles", "component_id").union(empty)


def keep_one(df: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """The rows of ``df``, all columns as they are: one per class, that with
    the smallest id; rows without n-grams all stay."""
    rows = ngram_classes(df.select("doc_id", "text"), n, percent)
    named = rows.where("n_shingles > 0")
    best = staged(named.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rkey")).alias("top")), "best")
    gone = staged(named.join(best, "root").where(F.col("rkey") != F.col("top.rkey"))
                  .select(F.col("rkey").alias("__rkey")).distinct(), "gone")
    kept = join_by_size(df.withColumn("__rkey", row_key(F.col("doc_id"), F.col("text"))),
                        gone, "__rkey", "left_anti")
    twice = staged(named.groupBy(F.col("rkey").alias("__rkey")).count().where("count > 1")
                   .select("__rkey", F.lit(True).alias("__twice")), "twice")
    if not twice.isEmpty():  # of repeated rows (same id and text) one stays too
        nth = F.when(F.col("__twice"), F.lit(0)).otherwise(F.monotonically_increasing_id() + 1)
        kept = (join_by_size(kept, twice, "__rkey", "left").withColumn("__nth", nth)
                .dropDuplicates(["__rkey", "__nth"]))
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])


def op9_ngram_join(spark, sf_dir: str) -> DataFrame:
    return ngram_components(documents(spark, sf_dir, "doc_id", "text"))
