"""Variable-capacity best-fit packing of documents into training sequences.

Lengths are whole numbers up to the largest permitted capacity, so the whole input is known to the
packer as a histogram: one count per length, however many documents there are. The driver packs
that histogram, longest first. Pieces go to the open bins with the least room that still fits;
otherwise a bin of the capacity with the least cost per word it can be filled with is opened (what
shorter pieces are left to fill it counts); finally each bin is cut to the least capacity that
holds its contents. All pieces of a length are placed in bulk: bins with equal contents are one
group, and the groups are at most a few per length.

Pieces are then numbered within their length by Spark, and the number says the bin. A hot length
is numbered in salted parts.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.words import WORD
from tidemark.session import named, small_or_not, stage

CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 64  # cost of a bin beside its capacity, in words
SALTS = 64


@dataclass
class Bins:
    """`count` bins with the same contents: (length, pieces of it in each bin), in order of placing."""

    capacity: int
    room: int
    count: int
    contents: tuple[tuple[int, int], ...]


def bin_cost(capacity: int, overhead: int = OVERHEAD) -> int:
    return capacity + overhead


def cheapest(length: int, count: int, shorter: int, capacities: tuple[int, ...], overhead: int) -> int:
    """Capacity with the least cost per word, for bins filled with this length and then with shorter pieces; the smaller in a tie."""
    def rate(capacity: int) -> float:
        own = min(count, capacity // length) * length
        return bin_cost(capacity, overhead) / (own + min(capacity - own, shorter))

    return min((c for c in capacities if c >= length), key=lambda c: (rate(c), c))


def pack_histogram(counts: dict[int, int], capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD) -> list[Bins]:
    """Groups of bins that hold `counts[length]` pieces of each length, with their final capacities."""
    capacities = tuple(sorted(set(capacities)))
    if not capacities or capacities[0] < 1:
        raise ValueError("capacities must be positive")
    if counts and (min(counts) < 1 or max(counts) > capacities[-1]):
        raise ValueError("lengths must be between 1 and the largest capacity")
    by_room: dict[int, list[Bins]] = defaultdict(list)
    rooms: list[int] = []  # sorted, those with open bins
    full: list[Bins] = []

    def put(bins: Bins) -> None:
        if bins.count and bins.room:
            if not by_room[bins.room]:
                insort(rooms, bins.room)
            by_room[bins.room].append(bins)
        elif bins.count:
            full.append(bins)

    def fill(bins: Bins, length: int, left: int) -> int:
        """Put up to `left` pieces into the bins, one bin after the other; how many remain."""
        each = bins.room // length
        whole, rest = min(bins.count, left // each), 0
        if whole < bins.count:
            rest = left - whole * each
        for count, pieces in ((whole, each), (1 if rest else 0, rest)):
            if count:
                put(Bins(bins.capacity, bins.room - pieces * length, count, (*bins.contents, (length, pieces))))
        put(Bins(bins.capacity, bins.room, bins.count - whole - (1 if rest else 0), bins.contents))
        return left - whole * each - rest

    shorter = sum(length * count for length, count in counts.items())
    for length in sorted((k for k, v in counts.items() if v), reverse=True):
        left = counts[length]
        shorter -= length * left
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                bins = by_room[room].pop()
                if not by_room[room]:
                    rooms.pop(at)
                left = fill(bins, length, left)
            else:
                capacity = cheapest(length, left, shorter, capacities, overhead)
                each = capacity // length
                left = fill(Bins(capacity, capacity, max(left // each, 1), ()), length, left)
    groups = full + [bins for room in rooms for bins in by_room[room]]
    for bins in groups:
        bins.capacity = capacities[bisect_left(capacities, sum(a * b for a, b in bins.contents))]
    return groups


def packing_runs(groups: list[Bins]) -> list[tuple[int, int, int, int, int, int, int]]:
    """(length, first number, numbers, pieces in a bin, first bin, capacity, position): where the pieces of a length go."""
    runs, used, first_bin = [], defaultdict(int), 0
    for bins in groups:
        position = 0
        for length, each in bins.contents:
            runs.append((length, used[length], bins.count * each, each, first_bin, bins.capacity, position))
            used[length] += bins.count * each
            position += length * each
        first_bin += bins.count
    return runs


def pieces_of(rows: DataFrame, largest: int) -> DataFrame:
    """(_row, _key, piece, first_word, n_words): texts of `_all` words cut into pieces of at most `largest`."""
    last = F.expr(f"(_all - 1) div {largest}")
    cut = rows.where("_all > 0").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    first = F.col("piece") * largest
    return cut.select("_row", "_key", "piece", first.alias("first_word"), F.least(F.lit(largest), F.col("_all") - first).cast("long").alias("n_words"))


def pack(
    df: DataFrame, key: str = "doc_id", text: str = "text", capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD,
    words: bool = False,
) -> DataFrame:
    """(key, piece, first_word, n_words, bin_id, capacity, position): every word of every text once.

    A text longer than the largest capacity is cut; its pieces may lie in different bins. Null
    texts and those without words have no piece. Keys may repeat or be null. With `words`, each
    row also has the piece's words, by one blank, as `text`.
    """
    spark = df.sparkSession
    salt = F.pmod(F.xxhash64("_row", "piece"), F.lit(SALTS))
    counted = df.select(named(key).alias("_key"), *([named(text).alias("_text")] if words else []), F.regexp_count(F.coalesce(named(text), F.lit("")), F.lit(WORD)).cast("long").alias("_all"))
    rows = stage(counted.withColumn("_row", F.monotonically_increasing_id()), "lengths")
    pieces = stage(pieces_of(rows, max(capacities)).withColumn("_salt", salt), "pieces")
    sizes = pieces.groupBy("n_words", "_salt").agg(F.count(F.lit(1)).alias("_count"))  # lengths x salts rows at most
    sizes = stage(sizes, "sizes")
    histogram = {r[0]: r[1] for r in sizes.groupBy("n_words").agg(F.sum("_count")).collect()}
    runs = packing_runs(pack_histogram(histogram, capacities, overhead))
    schema = "_length long, _from long, _numbers long, _each long, _bin long, capacity long, _position long"
    runs = stage(spark.createDataFrame(runs, schema), "runs")

    before = Window.partitionBy("n_words").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(sizes.select("n_words", "_salt", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_start")), "starts")
    within = F.row_number().over(Window.partitionBy("n_words", "_salt").orderBy("_row", "piece")) - 1
    numbered = pieces.withColumn("_n", within).join(small_or_not(starts), ["n_words", "_salt"])
    number = F.col("_n") + F.col("_start")
    inside = (F.col("n_words") == F.col("_length")) & (number >= F.col("_from")) & (number < F.col("_from") + F.col("_numbers"))
    placed = numbered.join(small_or_not(runs), inside)
    at = number - F.col("_from")
    out = placed.select(
        "_row", F.col("_key").alias(key), "piece", "first_word", "n_words", (F.col("_bin") + F.expr("(_n + _start - _from) div _each")).alias("bin_id"),
        "capacity", (F.col("_position") + at % F.col("_each") * F.col("n_words")).alias("position"),
    )
    if not words:
        return out.drop("_row")
    spelled = F.regexp_extract_all("_text", F.lit(WORD), F.lit(0))
    part = F.array_join(F.slice(spelled, (F.col("first_word") + 1).cast("int"), F.col("n_words").cast("int")), " ")
    return out.join(rows.select("_row", "_text"), "_row").withColumn("text", part).drop("_row", "_text")
