"""Text functions of the matcher and the joins. Native but for NFKC, the Ratcliff-Obershelp ratio and Python's rounding."""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Words that can't anchor a label, and number words with their values.
STOPWORDS = ["a", "an", "the", "of", "and", "or", "to", "in", "on", "for", "with", "at", "by", "from", "is", "are", "was", "were", "be", "been", "being", "this", "that", "these", "those"]
NUMBER_WORDS = {"zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12, "thirteen": 13, "fourteen": 14, "fifteen": 15, "sixteen": 16, "seventeen": 17, "eighteen": 18, "nineteen": 19, "twenty": 20, "a": 1, "an": 1}


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """difflib's ratio of two strings, in this order (it isn't symmetric); 0 if either is empty or null."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def py_round(x: pd.Series, digits: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(v) else round(v, int(d)) for v, d in zip(x, digits, strict=True)], dtype="float64")


def strip(s: Column) -> Column:
    """Without leading and trailing Unicode white space."""
    return F.regexp_replace(F.regexp_replace(s, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def norm_basic(s: Column, ascii_only: bool = False) -> Column:
    """NFKC, lower case, stripped. ascii_only skips NFKC, which leaves ASCII as it is."""
    return strip(F.lower(s if ascii_only else F.when(s.rlike(r"^[\x00-\x7F]*$"), s).otherwise(nfkc(s))))


def tokens(s: Column) -> Column:
    return F.filter(F.split(s, r"(?U)\s+"), lambda t: t != "")


def alnum_skeleton(norm: Column) -> Column:
    return F.regexp_replace(norm, "[^a-z0-9]+", "")


def numeric_skeleton(norm: Column) -> Column:
    """Commas between digits as dots, digits and dots only, the first dot only."""
    x = F.regexp_replace(F.regexp_replace(norm, r"(?<=\d),(?=\d)", "."), r"[^0-9.]+", "")
    return F.when(F.instr(x, ".") > 0, F.concat(F.substring_index(x, ".", 1), F.lit("."), F.replace(F.substring(x, F.instr(x, ".") + 1, F.length(x)), F.lit("."), F.lit("")))).otherwise(x)


def numericish(norm: Column) -> Column:
    return norm.rlike("[0-9]")


def token_equivalent(a: Column, b: Column) -> Column:
    """Of two normalised tokens. Two empty skeletons are equal."""
    both = numericish(a) & numericish(b) & (numeric_skeleton(a) == numeric_skeleton(b))
    return both | (alnum_skeleton(a) == alnum_skeleton(b))


def content_tokens(toks: Column) -> Column:
    """Tokens that are no stopwords; all of them where nothing else is left."""
    own = F.filter(toks, lambda t: ~t.isin(STOPWORDS))
    return F.when(F.size(own) > 0, own).otherwise(toks)


def anchor_score(tok: Column) -> Column:
    skel = alnum_skeleton(tok)
    return F.when(numericish(tok), 10.0).otherwise(0.0) + F.least(F.length(skel), F.lit(12)) / 12.0 * 2.0


def anchors(toks: Column, most: int = 5) -> Column:
    """The best tokens to look for, by score, then place; stopwords and tokens without letters and digits never are. A token that
    repeats takes up as many places."""
    ok = F.filter(toks, lambda t: ~t.isin(STOPWORDS) & (alnum_skeleton(t) != ""))
    ranked = F.array_sort(F.transform(ok, lambda t, i: F.struct((-anchor_score(t)).alias("s"), i.alias("i"), t.alias("t"))))
    return F.transform(F.slice(ranked, 1, most), lambda x: x["t"])


def first_number(candidates: Column) -> Column:
    """First whole number (up to 38 digits) in a list of answers, or the value of the first token that is a number word; answers in order, blank
    ones left out. Answers are normalised without NFKC (compose with norm_basic for other scripts)."""
    words = F.create_map(*(F.lit(v) for kv in NUMBER_WORDS.items() for v in kv))

    def one(s: Column) -> Column:
        digits = F.regexp_extract(s, r"(\d+)", 1)
        named = F.filter(F.transform(tokens(strip(F.lower(s))), lambda t: F.try_element_at(words, t)), lambda v: v.isNotNull())
        return F.when(digits != "", digits.try_cast("decimal(38,0)")).otherwise(F.get(named, F.lit(0)).cast("decimal(38,0)"))

    return F.get(F.filter(F.transform(candidates, one), lambda v: v.isNotNull()), F.lit(0))


def asks_how_many(question: Column) -> Column:
    return F.coalesce(F.lower(strip(question)).startswith("how many"), F.lit(False))


def key_text(s: Column) -> Column:
    """White space collapsed and stripped; null as empty."""
    return F.coalesce(strip(F.regexp_replace(s, r"(?U)\s+", " ")), F.lit(""))


def basename(p: Column) -> Column:
    return F.regexp_extract(p, r"([^/]*)$", 1)


def norm_filename(p: Column) -> Column:
    """Base name without leading pairs of dashes; an odd dash stays."""
    return F.regexp_replace(basename(p), "^(--)+", "")


def stem(p: Column) -> Column:
    """Base name without its suffix; leading and closing dots stay."""
    return F.regexp_replace(basename(p), r"(?<=.)\.[^.]+$", "")


def suffix(p: Column) -> Column:
    return F.lower(F.regexp_extract(basename(p), r"(?<=.)(\.[^.]+)$", 1))


def strip_label(s: Column, label: str) -> Column:
    """Without a leading 'label:' in any case and spacing."""
    pattern = r"(?i)^\s*" + r"\s*".join(label.split()) + r"\s*:\s*"
    return strip(F.regexp_replace(s, pattern, ""))


def page_numbers(s: Column) -> Column:
    """Whole numbers in a string, in order; null where there are none."""
    found = F.transform(F.regexp_extract_all(s, F.lit(r"(\d+)"), 1), lambda x: x.cast("int"))
    return F.when(F.size(found) > 0, found)


def safe_stem(s: Column) -> Column:
    """Runs of what is neither a letter, digit or underscore of any script nor - or . become one underscore."""
    return F.regexp_replace(s, r"(?U)[^\w\-.]+", "_")


def safe_ascii_stem(s: Column) -> Column:
    return F.regexp_replace(s, r"[^a-zA-Z0-9_\-]+", "_")


def number_if_possible(v: Column) -> Column:
    """A VARIANT or string as a VARIANT: whole numbers in strings and whole doubles as integers, other numbers in strings as doubles, the rest
    as it is."""
    text = F.try_variant_get(v, "$", "string")
    kind = F.coalesce(F.schema_of_variant(v), F.lit("VOID"))
    whole = F.trim(text).rlike(r"^[+-]?\d+$")
    number = F.trim(text).try_cast("double")
    integral = number.isNotNull() & (number == F.floor(number)) & (F.abs(number) < 9e15)
    as_json = F.when(whole, F.trim(text).try_cast("decimal(38,0)").cast("string")).when(integral, number.cast("long").cast("string")).when(number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf")), number.cast("string"))
    numeric = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|STRING)")
    return F.coalesce(F.when(numeric, F.try_parse_json(as_json)), v)


def whole_number(s: Column) -> Column:
    """A value read as a long; null where it can't be (booleans count as 0 and 1, doubles lose their fraction)."""
    return F.when(F.lower(s.cast("string")) == "true", 1).when(F.lower(s.cast("string")) == "false", 0).otherwise(s.try_cast("long")).cast("long")


def digits_only(s: Column) -> Column:
    """A string of digits as a long, else null."""
    return F.when(s.rlike(r"^\d+$"), s.try_cast("long"))


def octal(field: Column) -> Column:
    """A tar header's octal field up to its first NUL; 0 where it is blank or no octal number."""
    x = F.trim(F.substring_index(field, "\0", 1))
    return F.when(x.rlike("^[0-7]+$"), F.conv(x, 8, 10).cast("long")).otherwise(F.lit(0).cast("long"))


def round_up_512(n: Column) -> Column:
    return (F.ceil(n / 512.0) * 512).cast("long")


def truncated(s: Column, most: int) -> Column:
    """One line of at most `most` characters, the last one an ellipsis where something is left out."""
    x = F.replace(strip(s), F.lit("\n"), F.lit(" "))
    return F.when(F.length(x) > most, F.concat(F.left(x, F.lit(most - 1)), F.lit("…"))).otherwise(x)


@F.pandas_udf(T.ArrayType(T.StringType()))
def wrapped(s: pd.Series, width: pd.Series) -> pd.Series:
    """Lines of at most `width` characters; long words are broken, an empty text is one empty line."""
    import textwrap

    return pd.Series([textwrap.wrap((x or "").strip(), width=int(w), break_long_words=True, replace_whitespace=False) or [""] for x, w in zip(s, width, strict=True)], dtype=object)


@F.pandas_udf(T.ArrayType(T.StringType()))
def norm_list(s: pd.Series) -> pd.Series:
    """norm_basic of each string of a list."""
    return s.map(lambda xs: None if xs is None else [None if x is None else unicodedata.normalize("NFKC", x).lower().strip() for x in xs])


def distinct_by(items: Column, keys: Column) -> Column:
    """Items without those whose key (at the same place of keys) an earlier one has; order stays."""
    keyed = F.transform(items, lambda x, i: F.struct(F.get(keys, i).alias("k"), i.alias("i"), x.alias("x")))
    first = F.filter(keyed, lambda x: F.array_position(keys, x["k"]) == x["i"] + 1)
    return F.transform(first, lambda x: x["x"])


def label_texts(fallback: Column, more: Column) -> Column:
    """The answer and the possible answers, stripped, without blanks."""
    every = F.concat(F.array(fallback), F.coalesce(more, F.array().cast("array<string>")))
    return F.filter(F.transform(every, strip), lambda s: s.isNotNull() & (s != ""))


def label_candidates(labels: Column, keys: Column | None = None, most: int = 8) -> Column:
    """Labels to look for: distinct by their normalised forms (keys: norm_list of them; without, lower case), the first eight."""
    return F.slice(distinct_by(labels, F.transform(labels, lambda s: strip(F.lower(s))) if keys is None else keys), 1, most)


def deck_id(deck: Column, qid: Column, position: Column) -> Column:
    """The deck's own id, else one made from the question's id, else from the row's position (eight digits)."""
    return F.coalesce(deck.cast("string"), F.concat(F.lit("deck_unknown_from_"), qid.cast("string")), F.format_string("deck_unknown_%08d", position.cast("long")))


def mime_type(p: Column) -> Column:
    kinds = {".png": "image/png", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".webp": "image/webp", ".gif": "image/gif", ".bmp": "image/bmp"}
    out = F.lit("image/png")
    for k, v in kinds.items():
        out = F.when(suffix(p) == k, v).otherwise(out)
    return out


def strip_components(p: Column, n: int) -> Column:
    """Path without its first n parts; null where it has no more than that."""
    parts = F.filter(F.split(p, "/"), lambda x: (x != "") & (x != "."))
    return F.when(F.size(parts) > n, F.array_join(F.slice(parts, n + 1, F.greatest(F.size(parts) - n, F.lit(1))), "/"))


def safe_path(p: Column) -> Column:
    """Whether a member's path stays below the folder it is extracted to."""
    return F.coalesce(~p.startswith("/") & ~F.exists(F.split(p, "/"), lambda x: x == ".."), F.lit(False))


def json_object_in(reply: Column) -> Column:
    """The JSON object in a model's reply, as text: the whole reply without code fences, else from its first to its last brace."""
    bare = strip(F.regexp_replace(F.regexp_replace(strip(reply), r"^```[A-Za-z]*\s*", ""), r"\s*```$", ""))
    inner = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    is_object = lambda s: F.schema_of_variant(F.try_parse_json(s)).startswith("OBJECT")
    return F.when(is_object(bare), bare).when((inner != "") & is_object(inner), inner)
