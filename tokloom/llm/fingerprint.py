"""Document fingerprints by order MinHash.

A text is cut into units (up to eight characters of a word and the white
space after them); its k-mers are runs of ``K`` units, shorter at the end.
K-mers are numbered by occurrence, so a repeated one counts as often as it
stands.  The hash of (k-mer, occurrence) puts it into one of ``SLOTS`` slots;
a slot selects its two smallest, takes them in text order and hashes the
pair.  Two texts agree in a slot when the same k-mers were selected and
stand in the same order, so likeness falls with every edit, with moved
passages too.  Likeness is the share of agreeing slots among those that
either text fills.

DataFrame functions only: a k-mer is one packed integer (slot, hash, place),
arrays of them are sorted, and neighbours in the sorted array tell runs of
equal k-mers (their occurrence numbers) and the ends of slots.  No row meets
another.

The query's next document comes through one shuffle of the texts.  Ids are
cut into ranges of about ``RANGE_ROWS`` rows (quantiles of the ids, each cut
evenly; at most ``MOST_RANGES``), texts go to their range, and ``lead`` looks
ahead inside it.  The first text of each range is sent to the range before
as well, so every last row finds its successor there.

Defined cases: a null text counts as empty; the empty text, and only it,
fills no slot, and is like itself alone; texts of fewer than K units have
shorter k-mers; places are kept at any length; null ids come last in descending order, equal ids are ordered by text; a table's
only row is its own successor; an empty table gives no rows; columns other
than the two named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokloom.llm.common import documents, staged

K = 3
SLOTS = 64
UNIT = r"[^\s]{1,8}\s*|\s+"
#: Bits of a packed k-mer: 6 slot, 26 hash, 31 place (no array is longer).
PLACE, HASH = 31, 26
RANGE_ROWS, MOST_RANGES, QUANTILES = 250, 65536, 256


def _pack(h: Column, place: Column) -> Column:
    return F.shiftleft(h, PLACE).bitwiseOR(place.cast("long"))


def _kmer(packed: Column) -> Column:
    return F.shiftright(packed, PLACE)


def _slot(packed: Column) -> Column:
    return F.shiftright(packed, PLACE + HASH)


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << PLACE) - 1))


def _short(h: Column) -> Column:
    """The upper 32 bits: slot and hash."""
    return F.shiftrightunsigned(h, 64 - 6 - HASH)


def with_signature(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the column ``out``: the signature of a text column, an
    array of longs (32 bits of the pair's hash, 6 bits slot) in slot order.

    The steps are separate selects: each is used more than once by the next,
    so they stay separate columns and are computed once."""
    own = [F.col(f"`{c}`") for c in df.columns]
    u, h, s, e = (f"__{out}_{x}" for x in "uhse")
    df = df.select(*own, F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(UNIT),
                                              F.lit(0)).alias(u))
    df = df.select(*own, F.transform(u, lambda x, i: _short(F.xxhash64(
        x, *[F.get(F.col(u), i + j) for j in range(1, K)]))).alias(h))
    plain = F.transform(h, lambda x, i: _pack(x, i))
    df = df.select(*own, (F.size(F.array_distinct(h)) < F.size(h)).alias(e),
                   F.sort_array(plain).alias(s))
    # runs of equal k-mers: the o-th of a run is occurrence o, a k-mer of its own
    starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: (j == 0) | (
        _kmer(F.get(F.col(s), j)) != _kmer(F.get(F.col(s), j - 1))))
    runs = f"__{out}_r"
    df = df.select(*own, s, F.when(F.col(e), starts).alias(runs))

    def numbered(start, r):
        end = F.coalesce(F.get(F.col(runs), r + 1), F.size(s))
        return F.transform(F.slice(s, start + 1, end - start), lambda x, o: F.when(o == 0, x).otherwise(
            _pack(_short(F.xxhash64(_kmer(x), o)), _place(x))))

    df = df.select(*own, F.when(F.col(runs).isNull(), F.col(s)).otherwise(
        F.sort_array(F.flatten(F.transform(runs, numbered)))).alias(e))
    df = df.select(*own, F.filter(e, lambda x, j: (j < 2) | (
        _slot(F.get(F.col(e), j - 2)) != _slot(x))).alias(s))

    def pair(x, j):
        y = F.get(F.col(s), j + 1)
        hx, hy = _kmer(x), _kmer(y)
        value = (F.when(y.isNull() | (_slot(y) != _slot(x)), F.xxhash64(hx))
                 .when(_place(x) <= _place(y), F.xxhash64(hx, hy)).otherwise(F.xxhash64(hy, hx)))
        first = (j == 0) | (_slot(F.get(F.col(s), j - 1)) != _slot(x))
        return F.when(first, F.shiftleft(F.shiftrightunsigned(value, 32), 6).bitwiseOR(_slot(x)))

    return df.select(*own, F.filter(F.transform(s, pair), lambda x: x.isNotNull()).alias(out))


def likeness(a: str, b: str) -> Column:
    """Share of agreeing slots of two signature columns."""
    def slots(c):
        return F.transform(c, lambda x: x.bitwiseAND(F.lit(SLOTS - 1)))

    filled = F.size(F.array_union(slots(a), slots(b)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled)


def signature_text(c: str) -> Column:
    return F.array_join(F.transform(c, lambda x: F.lpad(F.lower(F.hex(x)), 10, "0")), "")


def _ranges(ids: DataFrame) -> Column:
    """Range number of doc_id, ascending with it; null ids: -1."""
    n = ids.count()
    if not n:
        return F.lit(0)
    total = min(max(1, -(-n // RANGE_ROWS)), MOST_RANGES)
    q = min(total, QUANTILES)
    cuts = ids.agg(F.percentile_approx("doc_id", [i / q for i in range(q + 1)], 10000)).first()[0]
    if not cuts:
        return F.lit(-1)
    cuts = sorted(set(cuts))
    sub = -(-total // max(1, len(cuts) - 1))
    low = F.array(*[F.lit(c) for c in cuts])
    k = F.greatest(F.size(F.filter(low, lambda c: c <= F.col("doc_id"))) - 1, F.lit(0))
    high = F.coalesce(F.get(low, k + 1), F.lit(cuts[-1] + 1))
    share = (F.col("doc_id") - F.get(low, k)) / (high - F.get(low, k))
    inner = F.greatest(F.lit(0), F.least(F.floor(share * sub), F.lit(sub - 1)))
    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise((k * sub + inner).cast("long")).cast("long")


def with_next(df: DataFrame) -> DataFrame:
    """Rows (doc_id, t, sig) with next_t and next_sig of the next document in
    descending id order, the first following the last."""
    ids = df.select("doc_id")
    number = _ranges(ids)
    heads = staged(ids.select("doc_id", number.alias("rng")).groupBy("rng").agg(
        F.max("doc_id").alias("head")), "heads")
    # at most MOST_RANGES rows: the range above each, the lowest above the highest
    up = Window.orderBy("rng")
    above = heads.withColumn("above", F.coalesce(
        F.lead("rng").over(up), F.lit(heads.agg(F.min("rng")).first()[0])))
    rows = df.withColumn("rng", number)
    to = F.broadcast(above.withColumnRenamed("rng", "__rng"))
    marked = rows.join(to, (F.col("rng") == F.col("__rng"))
                       & F.col("doc_id").eqNullSafe(F.col("head")), "left")
    places = F.when(F.col("above").isNull(), F.array("rng")).otherwise(F.array("rng", "above"))
    spread = marked.select("doc_id", "t", "sig", F.posexplode(places).alias("guest", "rng"))
    order = Window.partitionBy("rng").orderBy("guest", F.col("doc_id").desc_nulls_last(), "t")
    ahead = spread.select("doc_id", "t", "sig", "guest", F.lead(F.struct("t", "sig")).over(order).alias("ahead"))
    return ahead.where("guest = 0").select(
        "doc_id", "t", "sig", F.col("ahead.t").alias("next_t"), F.col("ahead.sig").alias("next_sig"))


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint of every row."""
    rows = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return with_signature(rows, "t", "sig").select("doc_id", signature_text("sig").alias("fingerprint"))


def op6_fingerprint(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("t"))
    pairs = with_next(with_signature(docs, "t", "sig"))
    n = F.length("t")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("t", F.lit(1), n - half), F.substring("next_t", F.lit(1), half))
    pairs = pairs.select("doc_id", n.cast("long").alias("n_chars"), "sig", "next_sig", edited.alias("edited"))
    both = with_signature(pairs, "edited", "edited_sig")
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        signature_text("sig").alias("fingerprint"),
        signature_text("edited_sig").alias("edited_fingerprint"),
        likeness("sig", "edited_sig").alias("near_edited"),
        likeness("sig", "next_sig").alias("near_next"))
