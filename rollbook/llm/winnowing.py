"""Document fingerprints by winnowing, in DataFrame functions alone.

Every run of ``k`` code points is hashed; of each window of ``w`` neighbouring hashes the least is selected, the rightmost
one where it occurs more than once. So two texts that share ``w + k - 1`` code points share a selected hash, and its
position says where. Hash and place are kept in one number (36 bits of hash, 27 bits that fall as the position
rises), whose least is the rightmost least hash; window minima come from minima over 2, 4, 8 and 16 neighbours. The runs are cut from pieces
of ``w`` code points and what reaches into the next; a hash rolled from code point to code point, in one scan by ``aggregate``, gave the same selection
but took over five times as long, as each step of such a scan makes new rows and arrays.

Long texts are cut into segments that overlap by ``w + k - 2`` code points, so that each window lies in one segment; windows
are selected in each, and the places of all segments are put together per document. Texts shorter than k are one run;
texts with fewer than w runs are one window.

Defined results: NULL counts as ''; an empty text has no hashes and the fingerprint ''. Equal texts have equal fingerprints;
the likeness of two texts is the share of common hashes (1 for two empty ones). Positions count code points, also beyond U+FFFF;
they are kept for texts of up to 2^27 code points, longer ones
raise. Extra columns are not carried along.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import let

K, W = 20, 32
SEGMENT = 2048
POSITION_BITS = 27
_TOP = (1 << POSITION_BITS) - 1


def _nothing() -> Column:
    return F.array().cast("array<bigint>")


def _blocks(segment: Column, first: Column, k: int, w: int) -> Column:
    """The numbers (hash, position) of all runs of a segment of at least k code points, in blocks of w by position."""
    def runs(text: Column, top: Column) -> Column:
        # the place of a character in a text is found by counting from the start, hence the short pieces; a byte's place is known
        return F.transform(F.sequence(F.lit(1), F.length(text) - (k - 1)), lambda i: F.shiftrightunsigned(F.xxhash64(F.substring(text, i, F.lit(k))), 1)
                           .bitwiseAND(F.lit(~_TOP)).bitwiseOR((top - i).cast("long")))

    def block(text: Column, nth: Column) -> Column:
        return let(F.lit(_TOP + 1) - first - nth * w, lambda top: F.when(
            F.length(text) == F.octet_length(text), let(text.cast("binary"), lambda raw: runs(raw, top))).otherwise(runs(text, top)))
    # each piece reaches into the next, so that it has all runs that begin in its first w code points
    pieces = F.regexp_extract_all(segment, F.lit(rf"(?s)(?=(.{{1,{w + k - 1}}})).{{1,{w}}}"), 1)
    return F.transform(F.filter(pieces, lambda t: F.length(t) >= k), block)


def _least(values: Column, w: int) -> Column:
    """The distinct least ones of each w neighbours, by position; all in one window where there are fewer.

    A step zips the minima with themselves moved on, which doubles their reach. -1, less than any number, fills the ends, so that of
    windows beyond them nothing else is left; this is cheaper than slices."""
    def ends(n: int) -> Column:
        return F.array_repeat(F.lit(-1).cast("long"), n)

    def spread(have: int, at: Column) -> Column:
        if have == w:
            return F.array_remove(F.array_distinct(at), F.lit(-1).cast("long"))
        step = min(have, w - have)
        return spread(have + step, let(at, lambda a: F.zip_with(F.concat(a, ends(step)), F.concat(ends(step), a), lambda x, y: F.least(x, y))))
    return let(values, lambda v: F.when(F.size(v) <= w, F.array(F.array_min(v))).otherwise(spread(1, v)))


def selected(segment: Column, first: Column, k: int = K, w: int = W) -> Column:
    """Distinct numbers (hash, position) selected in a segment whose first run has position ``first`` (from 0), by position."""
    short = F.shiftrightunsigned(F.xxhash64(segment), 1).bitwiseAND(F.lit(~_TOP)).bitwiseOR((F.lit(_TOP) - first).cast("long"))
    found = _least(F.flatten(_blocks(segment, first, k, w)), w)
    return F.when(F.length(segment) < k, F.array(short)).otherwise(found)


def segments(text: Column, k: int = K, w: int = W, size: int = SEGMENT) -> Column:
    """(nth, segment): pieces of ``size`` code points, each with the start of the next so that no window is lost."""
    more = w + k - 2
    cut = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{size}}}"), 0)
    return let(cut, lambda c: F.transform(c, lambda s, i: F.struct(
        i.alias("nth"), F.concat(s, F.substring(F.coalesce(F.get(c, i + 1), F.lit("")), 1, more)).alias("segment"))))


def places(text: Column, k: int = K, w: int = W) -> Column:
    """Distinct (hash, position) numbers of a whole text by position, segment by segment; none for an empty one."""
    # a short rest behind a full piece lies wholly in the piece before it, but for windows that begin in it
    return F.array_distinct(F.flatten(F.transform(segments(text, k, w), lambda s: F.when(
        (s["nth"] == 0) | (F.length(s["segment"]) >= w + k - 1), selected(s["segment"], s["nth"] * SEGMENT, k, w))
        .otherwise(_nothing()))))


def whole(text: Column) -> Column:
    """A text whose positions can be kept."""
    return F.when(F.length(text) > _TOP, F.raise_error(F.lit(f"a text of more than {_TOP} code points"))).otherwise(text)


def hashes_of(chosen: Column) -> Column:
    return F.array_distinct(F.transform(chosen, lambda c: F.shiftrightunsigned(c, POSITION_BITS)))


def fingerprint_of(chosen: Column) -> Column:
    """'hash@position' in order of position."""
    mask = (1 << POSITION_BITS) - 1
    pairs = F.array_sort(F.transform(chosen, lambda c: F.struct((F.lit(mask) - c.bitwiseAND(F.lit(mask))).alias("at"), F.shiftrightunsigned(c, POSITION_BITS).alias("h"))))
    return F.array_join(F.transform(pairs, lambda p: F.concat(F.lower(F.hex(p["h"])), F.lit("@"), p["at"].cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes; 1 if both have none."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def _known_in_prefix(chosen: Column, upto: Column, w: int = W) -> Column:
    """Of a text's numbers by position, those that its windows 0 to ``upto`` select.

    A number is first selected by the window it enters, if it is no larger in hash than the one before, and else by the first window
    that the one before has left.
    """
    position = lambda x: F.lit(_TOP) - x.bitwiseAND(F.lit(_TOP))
    hashed = lambda x: F.shiftrightunsigned(x, POSITION_BITS)

    def begins(x: Column, i: Column) -> Column:
        last = F.get(chosen, i - 1)
        return F.when(i == 0, 0).when(hashed(x) <= hashed(last), position(x) - w + 1).otherwise(position(last) + 1)
    return F.filter(chosen, lambda x, i: begins(x, i) <= upto)


def places_of_edited(edited: Column, own: Column, kept: Column, other: Column, taken: Column, k: int = K, w: int = W) -> Column:
    """``places`` of a text made of the first ``kept`` code points of one and the first ``taken`` of another, whose places are known:
    only windows across the seam are hashed anew."""
    span = w + k - 1
    begin = F.greatest(kept - span + 1, F.lit(0))
    seam = F.substring(edited, begin + 1, F.least(kept + taken, kept + span - 1) - begin)
    across = let(seam, lambda t: F.when(F.length(t) >= span, selected(t, begin, k, w)).otherwise(_nothing()))
    moved = F.transform(_known_in_prefix(other, taken - span, w), lambda x: x - kept)
    known = F.array_distinct(F.concat(_known_in_prefix(own, kept - span, w), across, moved))
    return F.when(kept + taken < span, places(edited, k, w)).otherwise(known)


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has its last floor(n / 2) code points replaced by the first as many of the next document, in ascending order
    of id (NULL first, ties by a hash of the text); the last one's next is the first. Documents are dealt out once, by ranges of
    ids as even as the quantiles make them; the next row is found within a range, and of each range the first id (one
    row a range) tells the range before which text follows its last row.
    """
    session = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    parts = int(session.conf.get("spark.sql.shuffle.partitions"))
    cuts = base.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)], 10 * parts)).head()[0] if parts > 1 else []
    cuts = sorted(set(cuts or []))
    part = F.size(F.filter(F.lit(cuts), lambda c: c < F.col("id"))) if cuts else F.lit(0)
    # the texts are hashed here, where they are read in even splits, before ranges of ids put them together
    base = base.withColumn("part", F.when(F.col("id").isNull(), 0).otherwise(part))
    rows = base.withColumn("own", places(whole(F.col("text"))))
    known = F.struct(F.col("id").isNotNull().alias("known"), "id", "mark")
    first = sorted((r["part"], r["head"]) for r in base.groupBy("part").agg(F.min(known).alias("head")).collect())
    if not first:
        heads = base.select("part", F.col("text").alias("head_text"))
    else:
        follows = [(p, first[(i + 1) % len(first)][1]) for i, (p, _) in enumerate(first)]
        wanted = F.array(*[F.struct(F.lit(p).alias("of_part"), F.lit(h["id"]).cast("long").alias("head_id"), F.lit(h["mark"]).alias("head_mark"))
                           for p, h in follows])
        wanted = session.range(1).select(F.inline(wanted))
        heads = (base.join(F.broadcast(wanted), F.col("id").eqNullSafe(F.col("head_id")) & (F.col("mark") == F.col("head_mark")))
                 .select(F.col("of_part").alias("part"), F.col("text").alias("head_text")).dropDuplicates(["part"]))
    heads = heads.withColumn("head_places", places(F.col("head_text")))
    order = Window.partitionBy("part").orderBy(F.col("id").asc_nulls_first(), "mark")
    lead = lambda c: F.lead(c).over(order)
    placed = rows.join(heads.hint("shuffle_hash"), "part", "left").withColumns({"inner": lead("text"), "inner_places": lead("own")})
    placed = placed.withColumns({"next": F.coalesce("inner", "head_text"), "next_places": F.coalesce("inner_places", "head_places"),
                                 "n": F.length("text"), "half": F.floor(F.length("text") / 2).cast("int")})
    placed = placed.withColumns({"kept": F.col("n") - F.col("half"), "taken": F.least("half", F.length("next"))})
    edited = F.concat(F.substring("text", F.lit(1), F.col("kept")), F.substring("next", F.lit(1), F.col("taken")))
    placed = placed.withColumn("edited", edited).withColumn("changed", places_of_edited(
        F.col("edited"), F.col("own"), F.col("kept"), F.col("next_places"), F.col("taken")))
    own, changed = hashes_of(F.col("own")), hashes_of(F.col("changed"))
    return placed.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_chars"), "edited", fingerprint_of(F.col("own")).alias("fingerprint"),
                         fingerprint_of(F.col("changed")).alias("edited_fingerprint"), likeness(own, changed).alias("near_edited"),
                         likeness(own, hashes_of(F.col("next_places"))).alias("near_next"))
