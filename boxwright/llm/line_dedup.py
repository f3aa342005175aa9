"""Line dedup by a segment-partition edit join. DataFrame functions only.

Lines fall into classes of length; the segments of a class have one size, the least length of the class (less threshold // 2) over
threshold + 1. The first half of a line's threshold + 1 segments is counted from its start, the rest from its end. Places in two lines that are
at most `threshold` edits apart are counted by the lesser of both indexes, from the start or from the end. Each edit then hits one place
at most, and as no more than threshold // 2 places are lost between the halves, one segment. So there is a segment i without
any, with i - 1 edits before and at most threshold + 1 - i after it; the line with the lesser index has it as its own, and in the other it
stands as many places further on (from its end, in the second half). So each distinct line is indexed under its segments and probes with
its substrings at those places: threshold + 1 own keys, and some (threshold + 2)^2 / 4 in all.
A line that is at most `threshold` longer than the class below belongs to both, so that lines of different length meet.

Keys that two lines share give pairs. Counts of letters and parities of words must nearly agree before a pair is verified: common
beginnings and ends go (they don't change the distance), and the rest runs through a banded bit-parallel automaton, whose
masks of 2 * threshold + 1 bits (one for each number of errors) hold the diagonals that are still alive.

Long lines are also held against each other word by word: the same join over arrays of words, with a threshold in words that grows
with the line. Each kind of comparison has its own range of lengths; a pair is compared under the range of its shorter line.

Links are counted without a pair for each where many lines share a key: lines of as many words are held against a pattern, the
commonest word at each place, or any word where none has half of the lines. Two lines that differ from a pattern with w such places
at p and q others are w + p + q edits of words apart at most. Pairs that this links are never made; how many a line has is a sum
over the numbers of lines at each distance. All other pairs are compared.

Lines of one class (components of verified links) keep their first occurrence by (document, line number).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .components import components
from .shared import cut, discard, reread, table

THRESHOLD = 2
#: Shorter lines are left alone.
MIN_CHARS = 10
#: Shorter lines are held against equal ones only: two edits are a large part of them.
MIN_EDIT_CHARS = 24
#: (least number of words, edits of whole words that link): long lines with inserted, replaced, left out or moved words.
WORD_CLASSES = ((12, 1), (24, 2), (64, 4))
#: How queries and the pipeline compare lines.
WHOLE: dict = {"min_chars": 1, "short_edit_chars": 10, "word_classes": WORD_CLASSES}
#: Letters whose counts must nearly agree before a pair is verified.
LETTERS = "enatiorshdlucmgb"
#: Copies of one line that may probe each by itself.
MANY_COPIES = 50
#: Lines of one key from which their links are counted by a pattern before pairs are made.
FAMILY = 64
#: How much longer lines of the next class of length are.
GROWTH = 1.2
#: Ids that may be broadcast (8 bytes each); beyond, joins deal both sides out.
BROADCAST_ROWS = 2_000_000


def _segment_size(c: Column, low: int | Column, t: int | Column, spare: int | Column) -> Column:
    """Size of the segments of class c: its least length, less what t edits can shift, over t + 1."""
    return F.floor((F.ceil(F.pow(F.lit(GROWTH), c) * low - 1e-6) - spare) / (t + 1)).cast("int")


def _places(threshold: int) -> Column:
    """Array of (segment, shift, from_end): where the segments of a near line may be. Shift 0 is the line's own segment."""
    out = []
    for i in range(1, threshold + 2):
        from_end = i > (threshold + 2) // 2
        shifts = range(i - threshold - 1, 1) if from_end else range(i)
        out += [F.struct(F.lit(i).alias("i"), F.lit(shift).alias("shift"), F.lit(from_end).alias("from_end")) for shift in shifts]
    return F.array(*out)


def keyed(lines: DataFrame, kinds: list[tuple], keep: list[str]) -> DataFrame:
    """(keep..., kind, key, own): hashes of a line's own segments and of the substrings where near lines may have theirs.

    lines has line, n (characters), words (array), n_words; kinds are those of line_classes(). Kinds and classes come from
    generators over constants: code that names each would be too long for the JVM to compile.
    """
    picked = []
    for k, (t, low, high, w, implied) in enumerate(kinds):  # a pair with so many words as implied is compared word by word
        one = {"k": k, "t": t, "low": low, "high": high or 2**31 - 1, "by_words": bool(w), "implied": implied or 2**31 - 1, "spare": t // 2}
        picked += [F.struct(*(F.lit(v).alias(name) for name, v in (one | {"below": below}).items())) for below in (False, True)]
    fields = lambda of, *names: [F.col(f"{of}.{x}").alias(x) for x in names]
    x = lines.select(*keep, "line", "words", "n", "n_words", F.explode(F.array(*picked)).alias("kind"))
    length = F.when(F.col("kind.by_words"), F.col("n_words")).otherwise(F.col("n"))
    # a class is a line's own, or the one below, which it must be so near to that it has another number
    x = x.where((length >= F.col("kind.low") + F.when(F.col("kind.below"), F.col("kind.t")).otherwise(0)) & (length <= F.col("kind.high")) & (F.col("n_words") < F.col("kind.implied")))
    at = lambda n: F.floor(F.log(n / F.col("low")) / F.lit(math.log(GROWTH)) + 1e-9).cast("int")
    x = x.select(*keep, "line", "words", length.alias("n"), *fields("kind", "k", "t", "low", "by_words", "spare", "below"))
    x = x.withColumn("c", at(F.when(F.col("below"), F.col("n") - F.col("t")).otherwise(F.col("n")))).where(~F.col("below") | (F.col("c") != at(F.col("n"))))
    x = _once(x, size=_segment_size(F.col("c"), F.col("low"), F.col("t"), F.col("spare")))
    places = F.element_at(F.array(*(_places(t) for t, *_ in kinds)), F.col("k") + 1)
    x = x.select(*keep, "line", "words", "n", "k", "t", "by_words", "c", "size", F.explode(places).alias("p"))
    size = F.col("size")
    first = F.when(F.col("p.from_end"), F.col("n") - (F.col("t") + 2 - F.col("p.i")) * size).otherwise((F.col("p.i") - 1) * size) + F.col("p.shift") + 1
    x = x.withColumn("first", first).where((F.col("first") >= 1) & (F.col("first") + size - 1 <= F.col("n")))
    piece = F.when(F.col("by_words"), F.xxhash64(F.slice("words", F.greatest("first", F.lit(1)), size))).otherwise(F.xxhash64(F.substring(F.col("line"), F.col("first"), size)))
    return x.select(*keep, F.col("k").alias("kind"), F.xxhash64(F.col("k") * 1000 + F.col("p.i"), F.col("c"), piece).alias("key"), (F.col("p.shift") == 0).alias("own"))


def letter_counts(line: Column, length: Column) -> Column:
    """Counts of sixteen letters, modulo 16, in the half bytes of a long."""
    out = F.lit(0).cast("long")
    for i, c in enumerate(LETTERS):
        out = out.bitwiseOR(F.shiftleft(((length - F.length(F.replace(line, F.lit(c), F.lit("")))) % 16).cast("long"), 4 * i))
    return out


def gray(counts: Column) -> Column:
    """Half bytes in Gray's code: one more or less, modulo 16, flips one bit."""
    return counts.bitwiseXOR(F.shiftright(counts, 1).bitwiseAND(F.lit(0x7777777777777777)))


def word_parities(texts: DataFrame) -> DataFrame:
    """(id, letters, w, n, id2) of texts (id, id2, line, letters): w has, in each of four longs, the parities of the counts of words in 64
    classes of a hash of its own; n is how many lines have the id. A row for each word is summed up as it is made."""
    x = texts.select("id", "id2", "letters", F.posexplode(F.split("line", " ")).alias("at", "word"))
    x = x.select("id", "id2", "letters", "at", F.xxhash64("word").alias("h"))
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright("h", 6 * i).bitwiseAND(F.lit(63)).cast("int"))
    x = x.groupBy("id").agg(F.max("letters").alias("letters"), F.max("id2").alias("id2"), F.count_if(F.col("at") == 0).alias("n"), *(F.bit_xor(bit(i)).alias(f"w{i}") for i in range(4)))
    return x.select("id", "letters", F.struct(*(f"w{i}" for i in range(4))).alias("w"), "n", "id2")


def may_be_near(a: Column, b: Column, threshold: int | Column) -> Column:
    """Whether counts of letters (gray) allow so few edits: each edit changes two of them by one at most."""
    return F.bit_count(a.bitwiseXOR(b)) <= 2 * threshold


def _shared(a: Column, b: Column, most: Column, side) -> Column:
    """Characters that the beginnings (side: F.left) or ends (F.right) of a and b share, at most `most`; by halving steps."""
    steps = F.filter(F.array(*(F.lit(1 << p) for p in range(30, -1, -1))), lambda s: s <= most)
    return F.aggregate(steps, F.lit(0), lambda k, s: F.when((k + s <= most) & (side(a, k + s) == side(b, k + s)), k + s).otherwise(k))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once for each row: projections aren't merged across a generator."""
    made = F.explode(F.array(F.struct(*(c.alias(k) for k, c in columns.items()))))
    return df.withColumn("_made", made).select(*df.columns, *(F.col(f"_made.{k}").alias(k) for k in columns))


def verified(pairs: DataFrame, a: str, b: str, threshold: int = THRESHOLD) -> DataFrame:
    """Rows of pairs whose strings a and b are at most `threshold` insertions, deletions or substitutions of characters apart.

    Mask e has bit threshold + d set if the first j + d characters of a turn into the first j of b with at most e edits.
    """
    x = _once(pairs, _la=F.length(a), _lb=F.length(b), _most=F.least(F.length(a), F.length(b)))
    la, lb = F.col("_la"), F.col("_lb")
    x = _once(x, _head=_shared(F.col(a), F.col(b), F.col("_most"), F.left))
    x = _once(x, _rest=F.col("_most") - F.col("_head"))
    x = _once(x, _tail=_shared(F.col(a), F.col(b), F.col("_rest"), F.right))
    x = _once(x, _m=la - F.col("_head") - F.col("_tail"), _n=lb - F.col("_head") - F.col("_tail"))
    x = x.where(F.abs(F.col("_m") - F.col("_n")) <= threshold)
    # what is left differs at both ends, so its inside takes threshold - 2 edits at most: one of threshold - 1 pieces is whole
    inner, pieces = F.col("_m") - 2, threshold - 1
    other = F.substring(F.col(b), F.col("_head") + 1, F.col("_n"))
    possible = F.greatest("_m", "_n") <= 1
    if pieces:
        size = F.floor(inner / pieces).cast("int")
        possible = F.col("_m") < 3 + pieces
        for k in range(pieces):
            possible = possible | F.contains(other, F.substring(F.col(a), F.col("_head") + 2 + k * size, size))
    x = x.where(possible)
    x = _once(x, **{name: F.split(F.substring(F.col(of), F.col("_head") + 1, F.col(n)), "") for name, of, n in (("_p", a, "_m"), ("_t", b, "_n"))})
    return x.where(_alive(threshold)).select(*pairs.columns)


def verified_words(pairs: DataFrame, a: str, b: str, threshold: int) -> DataFrame:
    """Rows of pairs whose strings a and b are at most `threshold` insertions, deletions or substitutions of words apart."""
    x = _once(pairs, _u=F.split(a, " "), _v=F.split(b, " "))
    x = _once(x, _most=F.least(F.size("_u"), F.size("_v"))).where(F.abs(F.size("_u") - F.size("_v")) <= threshold)

    def agree(p: Column, t: Column) -> Column:
        """How many elements the beginnings share."""
        other = F.array_position(F.zip_with(p, t, lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False))
        return F.when(other > 0, other - 1).otherwise(F.col("_most")).cast("int")

    x = _once(x, _head=agree(F.col("_u"), F.col("_v")), _back=agree(F.reverse("_u"), F.reverse("_v")))
    x = _once(x, _tail=F.least(F.col("_back"), F.col("_most") - F.col("_head")))
    x = _once(x, _m=F.size("_u") - F.col("_head") - F.col("_tail"), _n=F.size("_v") - F.col("_head") - F.col("_tail"))
    x = _once(x, _p=F.slice("_u", F.col("_head") + 1, F.col("_m")), _t=F.slice("_v", F.col("_head") + 1, F.col("_n")))
    # as in verified(): both ends differ, so the inside takes threshold - 2 edits at most and one of threshold - 1 pieces is whole
    short, pieces = F.greatest("_m", "_n") <= threshold, threshold - 1
    if not pieces:
        return x.where(short).select(*pairs.columns)
    spaced = lambda w: F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "))
    x = _once(x, _other=spaced(F.col("_t")), _size=F.greatest(F.floor((F.col("_m") - 2) / pieces).cast("int"), F.lit(0)))
    possible = short | (F.col("_m") < 3 + pieces)
    for k in range(pieces):
        possible = possible | F.contains("_other", spaced(F.slice("_p", 2 + k * F.col("_size"), F.col("_size"))))
    return x.where(possible).where(short | _alive(threshold)).select(*pairs.columns)


def _alive(threshold: int) -> Column:
    """Whether at most `threshold` edits turn array _p (of size _m) into _t (of size _n); sizes differ by so many at most."""
    full = (1 << (2 * threshold + 1)) - 1
    begin = F.struct(*(F.lit(sum(1 << (threshold + d) for d in range(e + 1))).alias(f"r{e}") for e in range(threshold + 1)))

    def mask(c: Column, j: Column) -> Column:
        """The diagonals on which element c, at place j of _t, equals that of _p."""
        out = F.lit(0)
        for d in range(-threshold, threshold + 1):
            out = out + F.when(F.get("_p", j + d) == c, F.lit(1 << (threshold + d))).otherwise(F.lit(0))
        return out

    def step(s: Column, match: Column) -> Column:
        new: list[Column] = []
        for e in range(threshold + 1):
            r = s[f"r{e}"].bitwiseAND(match)
            if e:  # a substitution, an insertion into a, a deletion from a
                before = s[f"r{e - 1}"]
                r = r.bitwiseOR(before).bitwiseOR(F.shiftright(before, 1)).bitwiseOR(F.shiftleft(new[-1], 1))
            new.append(r.bitwiseAND(F.lit(full)))
        return F.struct(*(r.alias(f"r{e}") for e, r in enumerate(new)))

    end = F.when(F.col("_n") == 0, begin).otherwise(F.aggregate(F.transform(F.slice("_t", F.lit(1), F.col("_n")), mask), begin, step))
    return end[f"r{threshold}"].bitwiseAND(F.expr(f"shiftleft(1, {threshold} + _m - _n)")) != 0


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line_no, line) for every line of documents with an id; lines end at line feeds."""
    src = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.posexplode(F.split(text_col, "\n")).alias("line_no", "line"))
    return src.select("doc_id", F.col("line_no").cast("long").alias("line_no"), "line")


def _kinds(threshold: int, min_edit_chars: int, short_edit_chars: int | None, word_classes: tuple) -> list[tuple]:
    """(threshold, least length, most, whether lengths are in words, number of words from which a later kind finds the same pairs).

    The longer of two lines may reach into the next range. `threshold` edits of characters are at most twice as many edits of words and
    change the number of words by `threshold` at most, so word classes that allow so many take in the character edits. So do the keys of
    a class of two edits of words for two of characters, though not its comparison (_by_keys): an edit of a character makes one word
    another, parts one or joins two. With the first and the last segment (of size s) both hit, x < s words before the first edit and r < s
    after the second, the lesser place after the first edit is x + 1 <= s, and that before the second 3 s + 1 - r - 2 >= 2 s at least, so
    the second segment is whole. Edits of the same words take three at most, which can't hit both ends.
    """
    enough = lambda most: most >= 2 * threshold or most == threshold == 2
    implied = next((low + threshold for i, (low, _) in enumerate(word_classes) if all(enough(most) for _, most in word_classes[i:])), None)
    kinds: list[tuple] = [(threshold, min_edit_chars, None, False, implied)]
    if short_edit_chars is not None:
        kinds.append((1, short_edit_chars, min_edit_chars, False, None))
    for i, (low, most) in enumerate(word_classes):
        kinds.append((most, low, word_classes[i + 1][0] - 1 + most if i + 1 < len(word_classes) else None, True, None))
    if any(low <= t + t // 2 for t, low, *_ in kinds):
        raise ValueError("lines that are compared must be longer than one and a half times the threshold")
    return kinds


def _by_keys(kinds: list[tuple]) -> list[int]:
    """Kinds by words whose keys stand for those of characters: their pairs are compared by characters too."""
    t, _, _, _, implied = kinds[0]
    return [k for k, (most, low, _, words, _) in enumerate(kinds) if words and implied is not None and low + t >= implied and most < 2 * t]


def _near_counts(a: str, b: str, kinds: list[tuple]) -> Column:
    """Whether two lines that share a key may be linked by their counts (letters, and parities w of words); unknown counts may.

    An edit of a word changes the counts of two words at most, one of a character of three: it may part a word or join two.
    """
    of = lambda values: F.element_at(F.array(*(F.lit(x) for x in values)), F.col("kind") + 1)
    within = lambda most: reduce(Column.__and__, (F.bit_count(F.col(f"{a}.w.w{i}").bitwiseXOR(F.col(f"{b}.w.w{i}"))) <= most for i in range(4)))
    chars = [kinds[0][0] if k in _by_keys(kinds) else None if words else t for k, (t, _, _, words, _) in enumerate(kinds)]
    by_words = within(of([2 * t if words else -1 for t, _, _, words, _ in kinds]))
    by_chars = within(of([-1 if t is None else 3 * t for t in chars])) & may_be_near(F.col(f"{a}.letters"), F.col(f"{b}.letters"), of([t or 0 for t in chars]))
    return F.coalesce(by_words | by_chars, F.lit(True))


def _pairs(known: DataFrame, kinds: list[tuple], apart: bool = False) -> DataFrame:
    """(a, b, kinds): lines that share a key which one of them has as its own; with apart those of different c."""
    keys = lambda x: [] if apart else [F.col("keys").alias(x)]
    near = lambda x: [F.col("near").alias(x)] if "near" in known.columns else []
    probe = known.select("key", "kind", F.col("id").alias("b"), F.col("f").alias("fb"), F.col("own").alias("ob"), F.col("c").alias("cb"), *keys("kb"), *near("nb"))
    index = known.where("own").select("key", F.col("id").alias("a"), F.col("f").alias("fa"), F.col("c").alias("ca"), *keys("ka"), *near("na"))
    # links that a pattern shows are counted without a pair
    unknown = ~F.coalesce((F.col("na.g") == F.col("nb.g")) & (F.col("na.p") + F.col("nb.p") <= F.col("na.room")), F.lit(False)) if near("") else F.lit(True)
    if apart:
        once = F.coalesce(F.col("ca") != F.col("cb"), F.lit(True)) & (~F.col("ob") | (F.col("a") < F.col("b")))
    else:  # lines with keys of their own in common meet under the least of these, others under the keys that one has and the other probes
        once = F.when(F.col("ob"), (F.col("a") < F.col("b")) & (probe["key"] == F.array_min(F.array_intersect("ka", "kb")))).otherwise(~F.arrays_overlap("ka", "kb"))
    met = probe.join(index, (probe["key"] == index["key"]) & (F.col("a") != F.col("b")) & _near_counts("fa", "fb", kinds) & unknown & once)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "kind").groupBy("a", "b").agg(F.collect_set("kind").alias("kinds"))


def _families(members: DataFrame, texts: DataFrame, kinds: list[tuple]) -> DataFrame | None:
    """(id, id2, g, p, room): lines of a family g, whose pattern they differ from at p places; two with p + p <= room are linked.

    None if no key has many lines. Lines belong together by their keys (the least id that keys reach in two steps) and number of words.
    """
    words = [(k, low, t) for k, (t, low, _, by_words, _) in enumerate(kinds) if by_words]
    near = cut(members.where(F.col("many") & F.col("own") & F.col("kind").isin([k for k, *_ in words])).select("key", "id").distinct(), "families")
    label = near.withColumn("g", F.col("id"))
    for _ in range(2):
        low = label.groupBy("key").agg(F.min("g").alias("g"))
        label = near.join(near.join(low, "key").groupBy("id").agg(F.min("g").alias("g")), "id")
    label = cut(label.select("id", "g").distinct(), "families")
    discard(near)
    n = label.count()
    if not n:
        discard(label)
        return None
    lines = texts.select("id", "id2", F.split("line", " ").alias("u")).join(F.broadcast(label) if n <= BROADCAST_ROWS else label, "id")
    lines = lines.groupBy("id").agg(F.min("id2").alias("id2"), F.min("u").alias("u"), F.min("g").alias("g"), F.count("*").alias("n")).where("n = 1")  # one line an id
    lines = cut(lines.select("id", "id2", "u", F.size("u").alias("n"), F.xxhash64("g", F.size("u")).alias("g")), "families")
    # the pattern is a line, mended at places where it isn't like the others
    first = reread(lines).groupBy("g").agg(F.min_by("u", "id").alias("v"), F.count("*").alias("total"))
    odd = F.filter(F.transform("u", lambda w, i: F.when(w != F.get("v", i), F.struct(i.alias("at"), w.alias("word")))), lambda x: x.isNotNull())
    held = cut(lines.join(first, "g").where(F.col("total") > 1).select("id", "id2", "g", "n", "total", "u", odd.alias("odd")), "families")
    common = held.select("g", "total", F.explode("odd").alias("x")).groupBy("g", "total", "x.at", "x.word").agg(F.count("*").alias("c"))
    common = common.groupBy("g", "total", "at").agg(F.max(F.struct("c", "word")).alias("top"), F.sum("c").alias("others"))
    as_first = F.col("total") - F.col("others")
    word = F.when(2 * F.greatest("top.c", as_first) >= F.col("total"), F.col("top.word"))  # null: any word
    mends = common.where((F.col("top.c") > as_first) | (2 * as_first < F.col("total"))).groupBy("g").agg(F.collect_list(F.struct("at", word.alias("word"))).alias("mends"))
    x = reread(held).join(mends, "g", "left").withColumn("mends", F.coalesce("mends", F.array().cast("array<struct<at:int,word:string>>")))
    plain = F.size(F.filter("odd", lambda d: ~F.exists("mends", lambda m: m["at"] == d["at"])))
    mended = F.size(F.filter("mends", lambda m: m["word"].isNotNull() & (m["word"] != F.get("u", m["at"]))))
    t = F.lit(-1)
    for _, low, most in words:  # as for a pair: the last range that begins at this number of words or below
        t = F.when(F.col("n") >= low, F.lit(most)).otherwise(t)
    room = t - F.size(F.filter("mends", lambda m: m["word"].isNull()))
    out = cut(x.select("id", "id2", "g", (plain + mended).alias("p"), room.alias("room")).where("p <= room"), "families")
    for y in (label, lines, held):
        discard(y)
    return out


def _family_links(families: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, n): lines and how many others of their family a pattern links them with; (a, b): links that tie all of these together."""
    node = F.struct("id", "id2")
    sizes = families.groupBy("g", "p").agg(F.count("*").alias("n")).groupBy("g").agg(F.collect_list(F.struct("p", "n")).alias("sizes"))
    with_self = F.aggregate(F.filter("sizes", lambda s: s["p"] + F.col("p") <= F.col("room")), F.lit(0).cast("long"), lambda n, s: n + s["n"])
    counts = reread(families).join(sizes, "g").select(node.alias("node"), (with_self - F.when(2 * F.col("p") <= F.col("room"), 1).otherwise(0)).alias("n")).where("n > 0")
    least = families.groupBy("g").agg(F.min(F.struct("p", "id", "id2")).alias("least"))
    ties = reread(families).join(least, "g").where((F.col("p") + F.col("least.p") <= F.col("room")) & (F.col("id") != F.col("least.id")))
    return counts, ties.select(F.struct("least.id", "least.id2").alias("a"), node.alias("b"))


def _verified_links(pairs: DataFrame, texts: DataFrame, kinds: list[tuple]) -> DataFrame:
    """(a, b): nodes (id, id2) of the pairs that edits of words or characters link, as a table."""
    line = lambda side: F.struct("id", "id2").alias(side)
    full = pairs.join(texts.select(F.col("id").alias("a"), line("la"), F.col("line").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), line("lb"), F.col("line").alias("tb")), "b")
    # by words first, under the largest threshold that a pair has met; what that links isn't compared by characters again
    by_words = [verified_words(full.where(F.array_max("kinds") == k), "ta", "tb", t).select("la", "lb") for k, (t, _, _, words, _) in enumerate(kinds) if words]
    linked = cut(reduce(DataFrame.union, by_words).distinct(), "linked") if by_words else full.select("la", "lb").where("false")
    left = full.join(linked, ["la", "lb"], "left_anti")
    found = []
    for k, (t, low, _, words, _) in enumerate(kinds):
        if not words:
            met = F.arrays_overlap("kinds", F.array(*(F.lit(x) for x in [k, *(_by_keys(kinds) if k == 0 else [])])))
            found.append(verified(left.where(met & (F.least(F.length("ta"), F.length("tb")) >= low)), "ta", "tb", t).select("la", "lb"))
    every = reduce(DataFrame.union, [reread(linked) if by_words else linked, *found])
    links = cut(every.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct(), "links")
    discard(linked)
    return links


def _connected(known: DataFrame, texts: DataFrame, kinds: list[tuple]) -> DataFrame:
    """(node, component) of all links, without making every link: components().

    First all lines of a key are held against its least and its greatest line: two rows for each line and key. Then lines of a key that
    are of different classes still are held against each other, all of them, so that no link between classes is missed. Ids that stand for two lines belong to no known class and meet all.
    """
    comp = None
    for hubs in (True, False):  # each round costs the driver its plans
        if comp is not None:  # keys whose lines are all of one class have done their part
            own = comp.select(F.col("node").alias("c"), "component")
            new = known.join(own, "c", "left").withColumn("c", F.coalesce("component", "c")).drop("component")
            open_keys = new.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count_if(F.col("c").isNull()).alias("odd")).where("lo < hi or odd > 0").select("key")
            left = cut(new.join(open_keys, "key", "left_semi"), "members-left")
        else:
            left = known
        if not hubs:
            pairs = _pairs(left, kinds, apart=True)
        else:
            ends = left.where("own").groupBy("key").agg(F.min(F.struct("id", "f", "c")).alias("lo"), F.max(F.struct("id", "f", "c")).alias("hi"))
            hub = ends.select("key", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("h")).select(F.col("key"), F.col("h.id").alias("hub"), F.col("h.f").alias("fh"), F.col("h.c").alias("ch"))
            met = left.join(hub, "key").where((F.col("id") != F.col("hub")) & F.coalesce(F.col("c") != F.col("ch"), F.lit(True)) & _near_counts("f", "fh", kinds))
            pairs = met.groupBy(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).agg(F.collect_set("kind").alias("kinds"))
        pairs = cut(pairs, "pairs")
        links = _verified_links(pairs, texts, kinds)
        edges = links if comp is None else links.unionAll(comp.select(F.col("component").alias("a"), F.col("node").alias("b")))
        new = components(edges, native=True)
        for x in (pairs, links, *([left, comp] if comp is not None else [])):
            discard(x)
        comp = new
    return comp


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, min_edit_chars: int = MIN_EDIT_CHARS, short_edit_chars: int | None = None, word_classes: tuple = (), count_links: bool = True) -> DataFrame:
    """(doc_id, line_no, n_chars, class_doc, class_line, n_links, kept) for every line of at least min_chars characters.

    (class_doc, class_line) is the first occurrence of the line's class, kept marks it; n_links counts different lines that are
    linked with the line directly: by `threshold` edits of characters (one edit from short_edit_chars to below min_edit_chars), or by the
    edits of words that word_classes allow. Without count_links there is no n_links and the classes are the same: pairs of lines that are
    known to be of one class aren't compared, so a large class makes no row for each of its links. Equal lines are one node, so copies
    make no links; a line is known by two 64-bit hashes. Documents without id or text have no lines here, empty lines are too short; rows that repeat an id count as one document. A text is
    split whole, so a line of a very long text costs what other lines cost; one line may be as long as a row's value. An empty
    table gives an empty one. Other columns are ignored.
    """
    kinds = _kinds(threshold, min_edit_chars, short_edit_chars, word_classes)
    lines = lines_of(docs, id_col, text_col).withColumn("n", F.length("line")).where(F.col("n") >= min_chars)
    lines = lines.withColumns({"id": F.xxhash64("line"), "id2": F.xxhash64(F.lit(1), "line")})
    places = cut(lines.select("doc_id", "line_no", "n", "id", "id2"), "places")
    # lines with many copies probe once, from their first place; the copies of the others fall together after the exchange
    firsts = places.groupBy("id", "id2").agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("c")).where("c > 1")
    firsts = cut(firsts, "firsts")
    often = firsts.where(F.col("c") > MANY_COPIES).select("id", "id2", "first")
    few = F.broadcast if often.count() <= BROADCAST_ROWS else lambda x: x
    compared = lines.where(F.col("n") >= min(low for _, low, _, w, _ in kinds if not w)).join(few(often), ["id", "id2"], "left")
    compared = compared.where(F.col("first").isNull() | (F.struct("doc_id", "line_no") == F.col("first")))
    compared = _once(compared.select("id", "line", "n"), words=F.split("line", " "))
    compared = _once(compared, n_words=F.size("words"))
    # members of keys that several lines have, one of them as its own: one exchange, read twice
    keys = keyed(compared, kinds, ["id"]).select("key", "id", (2 * F.col("kind") + F.col("own").cast("int")).alias("tag")).repartition("key")
    shared = keys.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count_if(F.col("tag") % 2 == 1).alias("owners")).where("lo < hi and owners > 0").select("key", (F.col("owners") > FAMILY).alias("many"))
    # a row for each such key is hashed, so that all keys needn't be sorted
    members = keys.join(shared.hint("shuffle_hash"), "key").select("key", "id", F.floor(F.col("tag") / 2).cast("int").alias("kind"), (F.col("tag") % 2 == 1).alias("own"), "many")
    members = cut(members.groupBy("key", "id", "kind").agg(F.max("own").alias("own"), F.max("many").alias("many")), "members")
    ids = cut(members.select("id").distinct(), "ids")
    few = F.broadcast if ids.count() <= BROADCAST_ROWS else lambda x: x
    texts = lines.select("id", "id2", "line", "n").join(few(ids), "id", "left_semi").groupBy("id", "id2").agg(F.any_value("line").alias("line"), F.any_value("n").alias("n"))
    texts = cut(texts.select("id", "id2", "line", gray(letter_counts(F.col("line"), F.col("n"))).alias("letters")), "texts")
    known = members.join(word_parities(texts), "id")
    if count_links:
        owned = members.where("own").groupBy("id", "kind").agg(F.collect_list("key").alias("keys"))  # a few for each class of a line
        known = known.join(owned, ["id", "kind"], "left").withColumn("keys", F.coalesce("keys", F.array().cast("array<bigint>")))
    families = _families(members, texts, kinds) if count_links and word_classes else None
    if families is not None:
        marks = families.select("id", F.struct("g", "p", "room").alias("near"))
        known = known.join(F.broadcast(marks) if families.count() <= BROADCAST_ROWS else marks, "id", "left")
    known = known.select("key", "id", "kind", "own", *(["keys"] if count_links else []), *(["near"] if families is not None else []), F.when(F.col("n") == 1, F.struct("letters", "w")).alias("f"), F.when(F.col("n") == 1, F.struct("id", "id2")).alias("c"))
    known = cut(known, "members")
    if count_links:
        pairs = cut(_pairs(known, kinds), "pairs")
        links = _verified_links(pairs, texts, kinds)
        discard(pairs)
        edges, ends = links, links.select(F.explode(F.array("a", "b")).alias("node"), F.lit(1).cast("long").alias("n"))
        if families is not None:
            counts, ties = _family_links(families)
            edges, ends = links.unionAll(ties), ends.unionAll(counts)
        comp = components(edges, native=True)
        degree = ends.groupBy("node").agg(F.sum("n").alias("n_links"))
        near = degree.join(comp, "node", "left").select("node.id", "node.id2", "n_links", F.coalesce("component", "node").alias("component"))
    else:
        comp = links = _connected(known, texts, kinds)
        nodes = comp.select("node", "component").unionAll(comp.select(F.col("component").alias("node"), "component").distinct())
        near = nodes.select("node.id", "node.id2", F.lit(None).cast("long").alias("n_links"), "component")
    # a row for each line that has copies or links: its first place and, with links, the first place of its component
    alone = places.join(few(near.select("id", "id2")), ["id", "id2"], "left_semi").groupBy("id", "id2").agg(F.min(F.struct("doc_id", "line_no")).alias("own_first"))
    linked = cut(near.join(alone, ["id", "id2"]).select("id", "id2", "n_links", "component", "own_first"), "linked")
    tops = linked.groupBy("component").agg(F.min("own_first").alias("top"))
    tops = cut(linked.join(tops, "component").select("id", "id2", "n_links", "top"), "tops")
    named = cut(firsts.select("id", "id2", "first").join(tops, ["id", "id2"], "full").select("id", "id2", F.coalesce("top", "first").alias("top"), "n_links"), "named")
    rows = places.join(named, ["id", "id2"], "left")
    top = lambda c: F.coalesce(F.col(f"top.{c}"), F.col(c))
    out = rows.select("doc_id", "line_no", F.col("n").cast("long").alias("n_chars"), top("doc_id").alias("class_doc"), top("line_no").alias("class_line"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    for x in (members, ids, texts, known, links, linked, tops, firsts, *([] if families is None else [families])):
        discard(x)
    if not count_links:
        out = out.drop("n_links")
    return out.withColumn("kept", (F.col("doc_id") == F.col("class_doc")) & (F.col("line_no") == F.col("class_line")))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with every line taken out that isn't the first of its class; all rows and columns stay, n_chars follows the text.

    Rows without id or text stay as they are. Rows that repeat an id lose the line numbers that any of them loses only where the line itself
    isn't kept for that document. Columns of any name may stand beside; none is read but the two named and n_chars.
    """
    gone = line_classes(docs, id_col, text_col, count_links=False, **options).where("not kept").select("doc_id", "line_no").distinct()
    gone = gone.groupBy("doc_id").agg(F.collect_list("line_no").alias("lines"))  # line numbers of one document
    x = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row")).join(gone.select(F.struct("doc_id", "lines").alias("gone")), F.col(f"row.`{id_col}`").cast("long") == F.col("gone.doc_id"), "left")
    text, lost = F.col(f"row.`{text_col}`"), F.col("gone").isNotNull()
    left = F.array_join(F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains("gone.lines", i.cast("long"))), "\n")
    made = {c: F.col(f"row.`{c}`") for c in docs.columns} | {text_col: F.when(lost, left).otherwise(text)}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(lost, F.length(left).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return x.select(*(v.alias(c) for c, v in made.items()))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_classes(table(spark, sf_dir, "documents"), **WHOLE)
