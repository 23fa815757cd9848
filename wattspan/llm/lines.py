"""Line deduplication: a segment-partition join on edit distance.

Two lines are linked when they differ by at most `edits(length)` single-character edits, the shorter
line's allowance. A line of length l is split into allowance-plus-one segments, one of which must occur
unchanged in any linked line, at a shift that the lengths bound; each line therefore probes, for each
length that it may be linked to, a few of its own substrings. Index and probe entries meet by the hash
of (length, segment number, substring). Candidates are verified by a banded bit-parallel automaton: one
bit mask of reachable diagonals for each number of edits. Linked lines form classes by connected
components; the document with the least doc_id keeps the class's first line, all other lines go.

Groups of near lines are united through one head per key before pairs are formed, so a group yields
about one comparison per line and key; only lines that share a key without being linked are paired. Lines
of crowded keys ask for a second agreement: of `PIECES` pieces of a line two edits touch one or two, so all
others stand unchanged in a linked line, before the first touched piece at their place, between the two
shifted by at most one, behind the last shifted by the lengths' difference. The lines meet by the hash of
all the untouched pieces together, and by the parities of their characters before texts are compared. Keys
that are still crowded are parted by the parities of their touched pieces, then cut these again, round by
round, down to single characters: lines that differ elsewhere part, so that no round compares more than
`CROWD` lines a key with one another.

Spark SQL functions only. Only hashes are shuffled, until texts meet their decisions by doc_id. A line
that fills more than 1 / `HOT_SHARE` of all line occurrences enters the join once, through a broadcast
list that can't exceed `HOT_SHARE` rows. Candidate lines are fetched through a bit table of fixed size.

Defined results: lines shorter than `MIN_LENGTH` code points or without a word are neither compared nor
removed; a text that loses all its lines becomes empty and its row stays; NULL texts and rows with NULL
doc_id pass unchanged; rows that share a doc_id count as one document, each keeping its own first
lines. Other columns pass through. An empty table gives an empty table. Lines are identified by 63 bits
of their hash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import let, unused, whole_text
from .graph import components

MIN_LENGTH = 10
TWO_EDITS_FROM = 20
MAX_EDITS = 2
HOT_SHARE = 50_000
_WORDS = 1 << 16
#: Keys with more entries ask for a second agreement before they form pairs.
CROWD = 16
PIECES = 4


def edits(length: int) -> int:
    return 0 if length < MIN_LENGTH else 1 if length < TWO_EDITS_FROM else MAX_EDITS


def probes(allowed: int, shorter: int) -> list[tuple[int, int]]:
    """(segment, shift) pairs to probe for lines `shorter` code points shorter than the probing one."""
    found = []
    for segment in range(allowed + 1):
        low = max(-segment, shorter - (allowed - segment))
        high = min(segment, shorter + (allowed - segment))
        found += [(segment, shift) for shift in range(low, high + 1)]
    return found


def line_hash(line: Column) -> Column:
    return F.xxhash64(line).bitwiseAND(-2)


def eligible(line: Column) -> Column:
    return (F.length(line) >= MIN_LENGTH) & line.rlike(r"[^\x20\x09-\x0D]")


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line, h): the eligible lines of each row, each once."""
    cut = F.explode(F.array_distinct(F.split(whole_text(), "\n")))
    return (docs.where("doc_id IS NOT NULL").select("doc_id", cut.alias("line"))
            .where(eligible(F.col("line"))).withColumn("h", line_hash(F.col("line"))))


def _probes_of(length: Column) -> Column:
    """What a line of this length looks up: structs of segments, lengths' difference, segment, shift.

    Literal lists, so that the keys are plain expressions behind the explode, which the JVM compiles.
    """
    def listed(found: list[tuple[int, int, int, int]]) -> Column:
        return F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("parts", "shorter", "segment", "shift"), f)]) for f in found])

    two = [(MAX_EDITS + 1, shorter, s, d) for shorter in range(MAX_EDITS + 1) for s, d in probes(MAX_EDITS, shorter)]
    # Just above a limit, shorter lines stand below it and have fewer segments.
    cases = F.when(length >= TWO_EDITS_FROM + MAX_EDITS, listed(two))
    for width in range(TWO_EDITS_FROM + 1, MIN_LENGTH - 1, -1):
        found = []
        for shorter in range(edits(width) + 1):
            allowed = edits(width - shorter)
            if allowed >= max(shorter, 1):
                found += [(allowed + 1, shorter, s, d) for s, d in probes(allowed, shorter)]
        cases = cases.when(length == width, listed(found))
    return cases


def entries(lines: DataFrame) -> DataFrame:
    """(key, mark): the lines' index entries (lowest bit set) and their further probes, marked by the line's hash."""
    probe = lines.select("h", "line", F.length("line").alias("n"), F.explode(_probes_of(F.length("line"))).alias("e")).select(
        "h", "line", (F.col("n") - F.col("e.shorter")).alias("size"), "e.*")
    begin, end = (F.expr(f"cast((size * {k}) div parts as int)") for k in ("segment", "(segment + 1)"))
    index = (F.col("shorter") == 0) & (F.col("shift") == 0)
    return probe.select(F.xxhash64("size", "segment", F.substring("line", begin + F.col("shift") + 1, end - begin)).alias("key"),
                        F.col("h").bitwiseOR(index.cast("long")).alias("mark"))


def first_seen(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(h, n, first_doc) of every line; (hot, rep_doc) of those above the share, at most HOT_SHARE rows."""
    counts = materialise(lines.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")), "lines-first")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts, counts.where((F.col("n") > max(total / HOT_SHARE, 1))).select(F.col("h").alias("hot"), F.col("first_doc").alias("rep_doc"))


def shared_keys(lines: DataFrame, hot: DataFrame) -> DataFrame:
    """(key, h, index, head): entries whose key two lines share; head: the key's least indexed line."""
    once = (lines.join(F.broadcast(hot), lines["h"] == hot["hot"], "left")
            .where("hot IS NULL OR doc_id = rep_doc"))
    keyed = entries(once).repartition("key")
    group = Window.partitionBy("key")
    line, index = F.col("mark").bitwiseAND(-2), F.col("mark").bitwiseAND(1) == 1
    met = keyed.select("key", "mark", F.min(line).over(group).alias("least"), F.max(line).over(group).alias("most"),
                       F.min(F.when(index, line)).over(group).alias("head"))
    return met.where("least != most AND head IS NOT NULL").select(
        "key", line.alias("h"), index.alias("index"), "head").distinct()


def _ordered(pairs: DataFrame, one: Column, other: Column) -> DataFrame:
    return pairs.where(one != other).select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct()


def within(one: Column, other: Column, allowed: Column) -> Column:
    """Whether two lines differ by at most `allowed` (1 or 2) edits.

    Bit r of mask e is set when the first j characters of `other` align with the first j + r - 2 of
    `one` at e edits. A character matches (bit stays), is replaced (bit stays, one edit more), is extra
    (bit moves down) or is skipped in `one` (bit moves up within the same step).
    """
    band = (1 << (2 * MAX_EDITS + 1)) - 1

    def run(p: Column, t: Column) -> Column:
        start = F.struct(F.lit(4).alias("s0"), F.lit(8).alias("s1"), F.lit(16).alias("s2"), F.lit(0).alias("j"))

        def step(s: Column, c: Column) -> Column:
            def moved(match: Column) -> Column:
                def widen(same: Column, less: Column, less_new: Column) -> Column:
                    return (same.bitwiseAND(match).bitwiseOR(less).bitwiseOR(F.shiftright(less, 1))
                            .bitwiseOR(F.shiftleft(less_new, 1)).bitwiseAND(band))

                n0 = s["s0"].bitwiseAND(match)
                return let(n0, lambda a: let(widen(s["s1"], s["s0"], a), lambda b: F.struct(
                    a.alias("s0"), b.alias("s1"), widen(s["s2"], s["s1"], b).alias("s2"), (s["j"] + 1).alias("j"))))

            bits = [F.when(F.get(p, s["j"] + r - MAX_EDITS) == c, 1 << r).otherwise(0) for r in range(2 * MAX_EDITS + 1)]
            match = bits[0]
            for bit in bits[1:]:
                match = match + bit
            dead = s["s0"].bitwiseOR(s["s1"]).bitwiseOR(s["s2"]) == 0
            return F.when(dead, s).otherwise(let(match, moved))

        final = F.get(F.array(*[F.lit(1 << r) for r in range(2 * MAX_EDITS + 1)]), F.size(p) - F.size(t) + MAX_EDITS)
        return F.aggregate(t, start, step, lambda s: (
            s["s0"].bitwiseOR(s["s1"]).bitwiseOR(F.when(allowed > 1, s["s2"]).otherwise(0)).bitwiseAND(final) != 0))

    size = F.abs(F.length(one) - F.length(other)) <= allowed
    return F.when(size, let(F.split(one, ""), lambda p: let(F.split(other, ""), lambda t: run(p, t)))).otherwise(F.lit(False))


def parity(line: Column) -> Column:
    """64 bits: whether each class of characters (code point modulo 64) occurs an odd number of times.

    One edit changes at most two of them, so lines that differ in more than 2 * MAX_EDITS are not near.
    """
    def flip(bits: Column, c: Column) -> Column:
        return bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(c), F.lit(64))))

    return F.aggregate(F.split(line, ""), F.lit(0).cast("long"), flip)


def _choices(pieces: int) -> Column:
    """(a, b, shift) at `pieces` pieces that refine a choice (a, b, shift) made at `pieces` / `PIECES`.

    Piece k is cut into the pieces from k * PIECES on, so that a touched piece holds the touched parts.
    """
    def parts(k: str) -> Column:
        return F.sequence(F.col(k) * PIECES, F.col(k) * PIECES + PIECES - 1)

    def shifts(x: Column, y: Column) -> Column:
        whole = F.array(F.lit(0))
        # Nothing lies between neighbours, so every shift gives them the same key.
        beside = F.array((F.col("longer") > 1).cast("int"))
        free = F.when(F.col("longer") == 0, F.array(F.lit(-1), F.lit(0), F.lit(1))).otherwise(
            F.when(F.col("longer") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1))))
        given = F.when(F.col("b") > F.col("a") + 1, F.array("shift")).otherwise(free)
        return F.when(x == y, whole).when(y == x + 1, beside).otherwise(given)

    every = F.flatten(F.transform(parts("a"), lambda x: F.flatten(F.transform(
        F.filter(parts("b"), lambda y: y >= x),
        lambda y: F.transform(shifts(x, y), lambda s: F.struct(x.alias("a"), y.alias("b"), s.alias("shift")))))))
    return F.filter(every, lambda e: (e["a"] < e["b"]) | (F.col("a") == F.col("b")))


def finer(choices: DataFrame, texts: DataFrame, pieces: int) -> DataFrame:
    """Keys of the untouched pieces for every refined choice of one or two touched ones.

    `first` and `last` are the touched pieces: where one of them is equal in both lines, the lines also
    meet under the choice without it, and need not meet here. Pieces are cut for the indexed line's
    length, `size`; a probing line is `longer`, by up to `MAX_EDITS`.
    """
    line, longer, size, shift = (F.col(c) for c in ("line", "longer", "size", "shift"))

    def cut(k: Column) -> Column:
        return F.floor(size * k / pieces).cast("int")

    made = (choices.join(texts, "h").select("h", "root", "parity", "longer", "line", F.explode(_choices(pieces)).alias("e"))
            .select("h", "root", "parity", "longer", "line", (F.length("line") - longer).alias("size"), "e.*"))
    a, b, alone = F.col("a"), F.col("b"), F.col("a") == F.col("b")
    head = F.substring(line, F.lit(1), cut(a))
    middle = F.when(alone, F.lit("")).otherwise(F.substring(line, cut(a + 1) + shift + 1, cut(b) - cut(a + 1)))
    tail = F.substring(line, cut(b + 1) + longer + 1, size - cut(b + 1))
    first, last = _touched(pieces)
    return made.select(
        F.xxhash64(size, a, b, head, middle, tail).alias("key"), F.xxhash64(first).alias("first"),
        F.when(~alone, F.xxhash64(last)).alias("last"), ((longer == 0) & (shift == 0)).alias("index"),
        "h", "root", "parity", "longer", "a", "b", "shift", (size <= pieces).alias("single"))


def _touched(pieces: int) -> tuple[Column, Column]:
    """The touched pieces of a choice; the second one is empty where both edits are in one piece."""
    line, longer, size, shift, a, b = (F.col(c) for c in ("line", "longer", "size", "shift", "a", "b"))

    def cut(k: Column) -> Column:
        return F.floor(size * k / pieces).cast("int")

    first = F.substring(line, cut(a) + 1, cut(a + 1) - cut(a) + F.when(a == b, longer).otherwise(shift))
    last = F.when(a == b, F.lit("")).otherwise(F.substring(line, cut(b) + shift + 1, cut(b + 1) - cut(b) + longer - shift))
    return first, last


def _blocks(count: int) -> list[int]:
    """Masks of the parity bits by their number modulo `count`, as signed longs."""
    masks = [sum(1 << bit for bit in range(block, 64, count)) for block in range(count)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def by_parity(entries_: DataFrame, texts: DataFrame, pieces: int) -> DataFrame:
    """The entries under keys that also hold a block of each touched piece's parities.

    An edit changes at most two parities. Two touched pieces hold one edit each, so that one of three
    blocks of either is equal in linked lines; one touched piece holds two edits, so that one of five is.
    """
    alone = F.col("a") == F.col("b")
    first, last = _touched(pieces)
    fields = ["key", "first", "last", "index", "h", "root", "parity", "longer", "a", "b", "shift", "single"]
    read = (entries_.select(*fields).join(texts, "h").withColumn("size", F.length("line") - F.col("longer"))
            .select(*fields, parity(first).alias("p"), parity(last).alias("q")))

    def pairs(one: int, other: int) -> Column:
        return F.array(*[F.struct(F.lit(j).alias("j"), F.lit(m).cast("long").alias("m"), F.lit(k).alias("k"), F.lit(n).cast("long").alias("n"))
                         for j, m in enumerate(_blocks(one)) for k, n in enumerate(_blocks(other) if other else [0])])

    spread = read.withColumn("e", F.explode(F.when(alone, pairs(2 * MAX_EDITS + 1, 0)).otherwise(pairs(3, 3))))
    key = F.xxhash64("key", "e.j", F.col("p").bitwiseAND(F.col("e.m")), "e.k", F.col("q").bitwiseAND(F.col("e.n")))
    return spread.select(key.alias("key"), *fields[1:], "p", "q", "e.j", "e.k")


def _least_block(count: int, bits: str) -> str:
    """SQL: the first block in which two entries' parities are equal."""
    return "CASE " + " ".join(f"WHEN ((p.{bits} ^ i.{bits}) & {m}) = 0 THEN {j}" for j, m in enumerate(_blocks(count))) + " END"


def met(entries_: DataFrame, more: str) -> DataFrame:
    """(one, other): entries of a key with its indexed ones, as far as they are not united."""
    pairs = entries_.alias("p").join(entries_.where("index").alias("i"), F.expr(f"p.key = i.key AND p.root != i.root {more}"))
    return pairs.select(F.col("p.h").alias("one"), F.col("i.h").alias("other"))


def met_by_pieces(crowd: DataFrame, texts: DataFrame) -> DataFrame:
    """(one, other) of the lines (h, root) that agree on all but one or two pieces.

    Crowded keys are parted by the parities of the touched pieces; where that leaves a crowd, the touched
    pieces are cut anew, until few lines agree or the pieces are single characters. Indexed lines that agree on all but two characters are all linked, so there they meet
    the least one of them only.
    """
    # Two indexed lines of one length would meet once from either side.
    near = ("AND (NOT p.index OR p.h < i.h) AND p.first != i.first AND coalesce(p.last != i.last, true) "
            f"AND bit_count(p.parity ^ i.parity) <= {2 * MAX_EDITS}")
    # Entries that agree in several blocks meet in the first of them.
    alike = near + (f" AND CASE WHEN p.a = p.b THEN bit_count(p.p ^ i.p) <= 4 AND p.j = {_least_block(2 * MAX_EDITS + 1, 'p')} "
                    f"ELSE bit_count(p.p ^ i.p) <= 2 AND bit_count(p.q ^ i.q) <= 2 "
                    f"AND p.j = {_least_block(3, 'p')} AND p.k = {_least_block(3, 'q')} END")
    zero = F.lit(0)
    choices = (texts.join(crowd, "h").select(
        "h", "root", parity(F.col("line")).alias("parity"), zero.alias("a"), zero.alias("b"), zero.alias("shift"),
        F.explode(F.array(*[F.lit(k) for k in range(MAX_EDITS + 1)])).alias("longer")))
    pieces, found = PIECES, []

    def shared(entries_: DataFrame) -> DataFrame:
        """The entries of keys that may link lines which are not united, with the least indexed line.

        Keys in which a touched piece is equal in all lines are left to the choice without that piece.
        """
        cut = materialise(entries_, "lines-pieces")
        keys = cut.groupBy("key").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"),
            F.min(F.when(F.col("index"), F.col("h"))).alias("least"),
            ((F.min("first") != F.max("first")) & F.coalesce(F.min("last") != F.max("last"), F.lit(True))).alias("touched")).where(
            "touched AND low != high AND least IS NOT NULL").select(
            "key", "least", (F.col("n") > CROWD).alias("crowded"))
        return materialise(cut.join(keys, "key"), "lines-alike")

    while True:
        agree = shared(finer(choices, texts, pieces))
        found.append(met(agree.where("NOT crowded"), near))
        agree = shared(by_parity(agree.where("crowded"), texts, pieces))
        found.append(met(agree.where("NOT crowded"), alike))
        bottom = agree.where("crowded AND single")
        found.append(bottom.where("index").select(F.col("h").alias("one"), F.col("least").alias("other")))
        found.append(met(bottom, f"AND NOT p.index {alike}"))
        choices = agree.where("crowded AND NOT single").select("h", "root", "parity", "a", "b", "shift", "longer").distinct()
        if choices.isEmpty():
            return reduce(DataFrame.union, found)
        pieces *= PIECES


def _wanted(hashes: DataFrame) -> DataFrame:
    """One row: a bit table of `_WORDS` 64-bit words in which every given hash has its bit."""
    slot = F.shiftright("h", 7).bitwiseAND(_WORDS - 1).cast("int")
    words = hashes.groupBy(slot.alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast((h >> 1) & 63 as int))")).alias("word"))
    every = hashes.sparkSession.range(_WORDS).select(F.col("id").cast("int").alias("slot"))
    return every.join(words, "slot", "left").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("slot", F.coalesce("word", F.lit(0).cast("long")).alias("word")))),
        lambda p: p["word"]).alias("bits"))


def roots_of_near(lines: DataFrame, hot: DataFrame) -> DataFrame:
    """(u, root) for every line that is linked to another one.

    First each entry is compared with its key's head, which unites groups of near lines in a number of
    comparisons that grows with their lines; then all pairs of a key that are not united yet.
    """
    shared = materialise(shared_keys(lines, hot), "lines-shared")
    ends = shared.select("h").distinct()
    bit = F.expr("(get(bits, cast((h >> 7) & %d as int)) >> cast((h >> 1) & 63 as int)) & 1" % (_WORDS - 1)) == 1
    texts = materialise(lines.withColumn("bits", _wanted(ends).scalar()).where(bit).select("h", "line")
                        .join(ends, "h", "left_semi").dropDuplicates(["h"]), "lines-texts")
    a = texts.select(F.col("h").alias("a"), F.col("line").alias("line_a"))
    b = texts.select(F.col("h").alias("b"), F.col("line").alias("line_b"))
    shorter = F.least(F.length("line_a"), F.length("line_b"))
    allowed = F.when(shorter >= TWO_EDITS_FROM, MAX_EDITS).otherwise(1)

    def verified(pairs: DataFrame, label: str) -> DataFrame:
        return materialise(pairs.join(a, "a").join(b, "b").where(
            within(F.col("line_a"), F.col("line_b"), allowed)).select("a", "b"), label)

    near_heads = verified(_ordered(shared, F.col("h"), F.col("head")), "lines-heads")
    united = components(near_heads, "a", "b")
    rooted = materialise(shared.join(united, shared["h"] == united["u"], "left").select(
        "key", "h", "index", F.coalesce("root", "h").alias("root")), "lines-rooted")
    apart = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")).where(
        "low != high").select("key", (F.col("n") > CROWD).alias("crowded"))
    open_ = materialise(rooted.join(apart, "key"), "lines-open")
    crowd = open_.where("crowded").select("h", "root").distinct()
    pairs = met(open_.where("NOT crowded"), "").union(met_by_pieces(crowd, texts))
    rest = verified(_ordered(pairs, F.col("one"), F.col("other")), "lines-rest")
    return components(near_heads.union(rest), "a", "b")


def decisions(docs: DataFrame) -> DataFrame:
    """(doc_id, gone, same): hashes of lines to drop, and (h, root) of lines that stand for one another."""
    lines = _lines(docs)
    first, hot = first_seen(lines)
    roots = roots_of_near(lines, hot)
    classed = first.join(roots, first["h"] == roots["u"], "left").select(
        "h", "n", "first_doc", F.coalesce("root", "h").alias("root"), F.col("root").isNotNull().alias("near"))
    keepers = classed.where("near").groupBy("root").agg(F.min("first_doc").alias("near_doc"))
    # Only lines that occur in several documents or have a near line need a decision.
    judged = (classed.where("near OR n > 1").join(keepers, "root", "left")
              .select("h", "root", F.coalesce("near_doc", "first_doc").alias("rep_doc")))
    met = lines.select("doc_id", "h").join(judged, "h").where("doc_id != rep_doc OR h != root")
    gone = F.col("doc_id") != F.col("rep_doc")
    return met.groupBy("doc_id").agg(
        F.collect_set(F.when(gone, F.col("h"))).alias("gone"),
        F.collect_set(F.when(~gone, F.struct("h", "root"))).alias("same"),
    )


def dedup(docs: DataFrame) -> DataFrame:
    """The documents without their repeated lines, and `line_counts`: (all, kept)."""
    key, gone, same, stay = (unused(docs, n) for n in ("_doc_id", "_gone", "_same", "_kept"))
    made = decisions(docs).select(F.col("doc_id").alias(key), F.col("gone").alias(gone), F.col("same").alias(same))
    joined = docs.join(made, docs["doc_id"] == made[key], "left")

    def kept(cut: Column) -> Column:
        def by_root(roots: Column) -> Column:
            return F.filter(cut, lambda x, i: ~eligible(x) | (
                ~F.coalesce(F.array_contains(gone, line_hash(x)), F.lit(False))
                & (F.array_position(roots, F.get(roots, i)) == i + 1)))

        def root(x: Column) -> Column:
            found = F.get(F.filter(same, lambda e: e["h"] == line_hash(x)), F.lit(0))
            return F.coalesce(found["root"], line_hash(x))

        return let(F.transform(cut, root), by_root)

    cut = F.split(F.col("text"), "\n")
    out = joined.withColumn(stay, F.when(docs["doc_id"].isNull(), cut).otherwise(let(cut, kept)))
    counts = F.struct(F.coalesce(F.size(cut), F.lit(0)).alias("all"), F.coalesce(F.size(stay), F.lit(0)).alias("kept"))
    return out.select(*[F.array_join(stay, "\n").alias("text") if c == "text" else docs[c] for c in docs.columns],
                      counts.alias(unused(docs, "line_counts")))


def strip(docs: DataFrame) -> DataFrame:
    """`dedup` without the counts; `n_chars`, where present, is brought up to date."""
    out = dedup(docs).drop(unused(docs, "line_counts"))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def query(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the hash of the text that stays."""
    return dedup(docs.select("doc_id", "text")).select(
        "doc_id", F.col("line_counts.all").alias("n_lines"),
        (F.col("line_counts.all") - F.col("line_counts.kept")).alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
