"""Text analysis as jobs on a token table (doc_id, pos, token).

Character filters are columns; a tokenizer turns a text column into the table; token filters are joins, windows and
projections on it.  Positions survive filters, so gaps stay visible to shingles.  Lists (stop words, synonyms, rules)
are tables; small ones are broadcast by Spark from their size.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.scalars import let

# ---- character filters ----------------------------------------------------------------------------------------------

#: Named entities: HTML's Latin-1, symbol and special names, a blank for &nbsp; and an apostrophe for &apos;.
ENTITIES = {name: chr(point) for name, point in name2codepoint.items()} | {"nbsp": " ", "apos": "'"}
ENTITY = "&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});"


def entity(c: Column) -> Column:
    """The character of one entity; an unknown name, or a number that is no character, stays as it is."""
    body = F.substring(c, F.lit(2), F.length(c) - 2)
    hexadecimal = body.rlike("^#[xX]")
    digits = F.when(hexadecimal, F.substring(body, 3, 6)).otherwise(F.conv(F.substring(body, 2, 7), 10, 16))
    point = F.conv(digits, 16, 10).cast("long")
    valid = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
    number = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))
    names = F.map_from_arrays(F.array(*map(F.lit, ENTITIES)), F.array(*map(F.lit, ENTITIES.values())))
    return F.coalesce(F.when(body.startswith("#"), number).otherwise(F.try_element_at(names, body)), c)


#: A noncharacter, which no text interchange carries; it marks openings that have no end.
UNCLOSED = "\ufdd0"


def _up_to_last(c: Column, end: str, head: Callable[[Column], Column], tail: Callable[[Column], Column]) -> Column:
    """`head` of the text up to the last `end` and `tail` of the rest, joined; finding it is one pass forward and one back."""

    def both(s: Column) -> Column:
        return F.concat(head(s["head"]), tail(F.substring(s["c"], F.length(s["head"]) + 1, F.length(s["c"]))))

    return let(let(c, lambda x: F.struct(x.alias("c"), F.regexp_extract(x, f"(?is)^(.*{end})", 1).alias("head"))), both)


def html_strip(c: Column, escaped_tags: tuple[str, ...] = ()) -> Column:
    """Scripts, styles, comments and tags become blanks, tags named in `escaped_tags` stay, then entities are decoded once.

    An opening without an end is no script, style, comment or tag.  Those are marked first, behind the last end of their
    kind, so that every search for an end finds one: the time grows with the length of the text, whatever it holds.
    """
    same = lambda x: x
    for opening, end in ((r"<(?=script\b)", "</script>"), (r"<(?=style\b)", "</style>"), ("<(?=!--)", "-->")):
        c = _up_to_last(c, end, same, lambda x, opening=opening: F.regexp_replace(x, f"(?i){opening}", f"<{UNCLOSED}"))
    c = F.regexp_replace(c, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", " ")
    c = F.replace(c, F.lit(f"<{UNCLOSED}"), F.lit("<"))
    spared = rf"(?!/?(?:{'|'.join(map(re.escape, escaped_tags))})\b)" if escaped_tags else ""
    c = _up_to_last(c, ">", lambda x: F.regexp_replace(x, f"(?i)<{spared}[^>]*>", " "), same)

    def decode(c: Column) -> Column:
        decoded = F.transform(F.regexp_extract_all(c, F.lit(ENTITY), F.lit(0)), entity)
        joined = F.zip_with(F.split(c, ENTITY, -1), F.concat(decoded, F.array(F.lit(""))), lambda text, value: F.concat(text, value))
        return F.when(c.contains("&"), F.array_join(joined, "")).otherwise(c)

    return let(c, decode)


def mapping(c: Column, pairs: dict[str, str]) -> Column:
    """Literal replacements, longest key first."""
    for k in sorted(pairs, key=lambda k: (-len(k), k)):
        c = F.replace(c, F.lit(k), F.lit(pairs[k]))
    return c


def pattern_replace(c: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(c, pattern, replacement)


# ---- tokenizers: columns of token arrays ----------------------------------------------------------------------------


def _non_empty(array: Column) -> Column:
    return F.filter(array, lambda t: t != "")


def standard(c: Column, max_token_length: int = 255) -> Column:
    """Runs of letters, digits and underscores; longer ones are cut."""
    found = F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    cut = F.transform(found, lambda t: F.when(F.length(t) <= max_token_length, F.array(t)).otherwise(F.regexp_extract_all(t, F.lit(f".{{1,{max_token_length}}}"), F.lit(0))))
    return F.flatten(cut)


def whitespace(c: Column) -> Column:
    return _non_empty(F.split(c, r"\s+"))


def letter(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"\p{L}+"), F.lit(0))


def keyword(c: Column) -> Column:
    return F.array(c)


def pattern(c: Column, regex: str, group: int = -1) -> Column:
    """Split on a regex, or extract a group of every match."""
    return _non_empty(F.split(c, regex)) if group < 0 else F.regexp_extract_all(c, F.lit(regex), F.lit(group))


def char_group(c: Column, characters: str) -> Column:
    return _non_empty(F.split(c, "[" + re.escape(characters) + "]"))


def ngrams(c: Column, low: int, high: int, edge: bool = False) -> Column:
    """All substrings of the lengths low..high by start and length; with `edge`, the prefixes only."""
    n = F.length(c)

    def starts(size: Column) -> Column:
        last = F.lit(1) if edge else n - size + 1
        return F.transform(F.sequence(F.lit(1), last), lambda at: F.substring(c, at, size))

    sizes = F.sequence(F.lit(low), F.least(F.lit(high), n))
    return F.when(n >= low, F.flatten(F.transform(sizes, starts))).otherwise(F.array().cast("array<string>"))


def path_hierarchy(c: Column, delimiter: str = "/", replacement: str | None = None, skip: int = 0, reverse: bool = False) -> Column:
    """Every ancestor of a path; with `reverse`, every tail."""
    parts = F.slice(F.split(c, "\\" + delimiter), skip + 1, 1_000_000)
    join = replacement or delimiter
    if reverse:
        return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), join))
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), join))


def url_email(c: Column) -> Column:
    """URLs and e-mail addresses stay whole.

    The patterns are possessive, so that a host of many labels needs no recursion, and addresses are looked for only in
    blank-separated pieces with an @, as no token has a blank.
    """
    url, email, word = r"https?://[^\s<>\"]++", r"[\w.+-]++@[\w-]++(?:\.[\w-]++)++", r"[\p{L}\p{N}_]++"

    def found(text: Column, *alternatives: str) -> Column:
        return F.regexp_extract_all(text, F.lit("|".join(alternatives)), F.lit(0))

    pieces = F.transform(F.split(c, r"\s+"), lambda p: F.when(p.contains("@"), found(p, url, email, word)).otherwise(found(p, url, word)))
    return F.when(c.contains("@"), F.flatten(pieces)).otherwise(found(c, url, word))


def tokens(df: DataFrame, id_col: str, array: Column) -> DataFrame:
    """The token table of a column of token arrays; null texts give no tokens."""
    return df.select(F.col(id_col).alias("doc_id"), F.posexplode(array).alias("pos", "token"))


# ---- token filters --------------------------------------------------------------------------------------------------


def each(table: DataFrame, fn: Callable[[Column], Column]) -> DataFrame:
    """A scalar filter; tokens that become null or empty go."""
    return table.withColumn("token", fn(F.col("token"))).where("token IS NOT NULL AND token <> ''")


#: Letters that don't decompose, and what they fold to: fixed values.
SINGLE = dict(zip("ØøĐđĦħıŁłŊŋŦŧƀƁƆƇƈƉƊƏƐƑƒƗƘƙƝƠơƤƥƫƬƭƮƯưƲƳƴƵƶ", "OoDdHhiLlNnTtbBOCcDDEEFfIKkNOoPptTtTUuVYyZz", strict=True))
DOUBLE = {"ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "TH", "ĳ": "ij", "Ĳ": "IJ", "ð": "d", "Ð": "D"}


def _decomposed() -> dict[str, str]:
    """Latin letters with marks, by Unicode's decomposition."""
    letters = (chr(i) for i in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)))
    bases = {c: "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)) for c in letters}
    return {c: b for c, b in bases.items() if len(b) == 1 and b.isascii() and b.isalpha()}


FOLDS = _decomposed() | SINGLE
ACCENTED, FOLDED = "".join(FOLDS), "".join(FOLDS.values())


def fold(c: Column) -> Column:
    """Accents stripped; what has no character beyond ASCII is left as it is at once."""
    folded = F.translate(c, ACCENTED, FOLDED)
    for letter, two in DOUBLE.items():
        folded = F.replace(folded, F.lit(letter), F.lit(two))
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(folded)


def asciifolding(table: DataFrame, preserve_original: bool = False) -> DataFrame:
    """Strip accents; optionally keep the original at the same position."""
    if not preserve_original:
        return each(table, fold)
    both = F.array_distinct(F.array(fold(F.col("token")), F.col("token")))
    return table.withColumn("token", F.explode(both))


def length(table: DataFrame, low: int = 0, high: int = 2**31 - 1) -> DataFrame:
    return table.where(F.length("token").between(low, high))


def few(listed: DataFrame, most: int = 100_000) -> DataFrame:
    """A list, to be broadcast if it is counted and has up to `most` rows: else Spark, which doesn't know how long a list made
    by a program is, would shuffle the tokens to it."""
    return F.broadcast(listed) if listed.limit(most + 1).count() <= most else listed


def stop(table: DataFrame, words: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Drop listed tokens (column word); positions keep the gap."""
    key = F.lower if ignore_case else (lambda c: c)
    listed = words.select(key(F.col("word")).alias("_w")).distinct()
    return table.join(few(listed), key(table["token"]) == F.col("_w"), "left_anti")


def keep(table: DataFrame, words: DataFrame) -> DataFrame:
    """Keep only listed tokens."""
    return table.join(few(words.select(F.col("word").alias("token")).distinct()), "token", "left_semi").select(*table.columns)


def token_type(c: Column) -> Column:
    return F.when(c.rlike(r"^\p{N}+$"), "number").when(c.rlike(r"^\p{L}+$"), "word").otherwise("mixed")


def keep_types(table: DataFrame, types: list[str], include: bool = True) -> DataFrame:
    hit = token_type(F.col("token")).isin(types)
    return table.where(hit if include else ~hit)


def unique(table: DataFrame, same_position: bool = False) -> DataFrame:
    """The first of repeated tokens of a document, or of a position."""
    if same_position:
        return table.dropDuplicates(["doc_id", "pos", "token"])
    return table.groupBy("doc_id", "token").agg(F.min("pos").alias("pos")).select("doc_id", "pos", "token")


def gram_filter(table: DataFrame, low: int, high: int, edge: bool = True, side: str = "front", preserve_original: bool = False) -> DataFrame:
    """Grams of each token at its position."""
    token = F.col("token")
    grams = ngrams(F.reverse(token), low, high, True) if edge and side == "back" else ngrams(token, low, high, edge)
    if edge and side == "back":
        grams = F.transform(grams, F.reverse)
    if preserve_original:
        grams = F.array_distinct(F.concat(grams, F.array(token)))
    return table.withColumn("token", F.explode(grams))


def shingles(table: DataFrame, low: int = 2, high: int = 2, separator: str = " ", unigrams: bool = True, filler: str = "_", stacked: bool = False) -> DataFrame:
    """Word n-grams by position; a gap left by a filter reads as the filler.

    A table with a column `span`, or one that is said to be `stacked`, may have several tokens at a position: then every
    path through them counts (see path_shingles).
    """
    if stacked or "span" in table.columns:
        return path_shingles(table, low, high, separator, unigrams, filler)
    order = Window.partitionBy("doc_id").orderBy("pos")
    next_pos = [F.lead("pos", i).over(order) for i in range(1, high)]
    rows = table.select("*", *[F.lead("token", i).over(order).alias(f"_t{i}") for i in range(1, high)], *[p.alias(f"_p{i}") for i, p in enumerate(next_pos, 1)])
    last = F.max("pos").over(Window.partitionBy("doc_id"))
    rows = rows.withColumn("_last", last)
    parts = []
    for ahead in range(1, high):
        hit = F.lit(filler)
        for i in range(1, high):
            hit = F.when(F.col(f"_p{i}") == F.col("pos") + ahead, F.col(f"_t{i}")).otherwise(hit)
        parts.append(hit)
    out = [F.struct(F.lit(n).alias("size"), F.concat_ws(separator, "token", *parts[: n - 1]).alias("token")) for n in range(max(2, low), high + 1)]
    grams = F.filter(F.array(*out), lambda g: F.col("pos") + g["size"] - 1 <= F.col("_last"))
    if unigrams:
        grams = F.concat(F.array(F.struct(F.lit(1).alias("size"), F.col("token").alias("token"))), grams)
    return rows.select("doc_id", "pos", F.explode(grams).alias("g")).select("doc_id", "pos", F.col("g.token").alias("token"), F.col("g.size").alias("size"))


def _graph(table: DataFrame) -> DataFrame:
    """doc_id, pos, token, span of every different token; a token leads to those that begin where its span ends."""
    return table.select("doc_id", "pos", "token", (F.col("span") if "span" in table.columns else F.lit(1)).cast("int").alias("span")).distinct()


def _ahead(table: DataFrame, *more: str) -> DataFrame:
    return table.select(F.col("doc_id").alias("_d"), F.col("pos").alias("_p"), F.col("token").alias("_t"), F.col("span").alias("_n"), *more)


def path_shingles(table: DataFrame, low: int = 2, high: int = 2, separator: str = " ", unigrams: bool = True, filler: str = "_") -> DataFrame:
    """doc_id, pos, token, size: n-grams along all paths of a token graph, in which tokens are stacked at positions and span
    several.  A position without a token, up to the document's last, reads as the filler."""
    graph = _graph(table)
    after = F.lead("pos").over(Window.partitionBy("doc_id").orderBy("pos"))
    gaps = graph.select("doc_id", "pos").distinct().withColumn("_next", after).where("_next > pos + 1")
    gaps = gaps.select("doc_id", F.explode(F.sequence(F.col("pos") + 1, F.least(F.col("_next") - 1, F.col("pos") + high - 1))).alias("pos"))
    nodes = _ahead(graph.unionByName(gaps.select("doc_id", "pos", F.lit(filler).alias("token"), F.lit(1).alias("span")).distinct()))
    grams = graph.select("doc_id", "pos", "token", (F.col("pos") + F.col("span")).alias("_end"))
    out = grams.withColumn("size", F.lit(1)) if unigrams or low < 2 else None
    for n in range(2, high + 1):
        joined = grams.join(nodes, (F.col("doc_id") == F.col("_d")) & (F.col("_end") == F.col("_p")))
        grams = joined.select("doc_id", "pos", F.concat_ws(separator, "token", "_t").alias("token"), (F.col("_p") + F.col("_n")).alias("_end"))
        if n >= low:
            sized = grams.withColumn("size", F.lit(n))
            out = sized if out is None else out.unionByName(sized)
    return out.select("doc_id", "pos", "token", "size").distinct()


def path_common_grams(table: DataFrame, words: DataFrame, separator: str = "_") -> DataFrame:
    """All tokens, and bigrams of neighbours on any path of the graph of which one is a common word."""
    listed = words.select(F.col("word").alias("token"), F.lit(True).alias("_c")).distinct()
    graph = _graph(table).join(listed, "token", "left").withColumn("_c", F.coalesce("_c", F.lit(False)))
    pairs = graph.join(_ahead(graph, F.col("_c").alias("_o")), (F.col("doc_id") == F.col("_d")) & (F.col("pos") + F.col("span") == F.col("_p"))).where(F.col("_c") | F.col("_o"))
    return graph.select("doc_id", "pos", "token").unionByName(pairs.select("doc_id", "pos", F.concat_ws(separator, "token", "_t").alias("token"))).distinct()


def common_grams(table: DataFrame, words: DataFrame, separator: str = "_", stacked: bool = False) -> DataFrame:
    """All tokens, and bigrams of neighbours of which one is a common word; `stacked` as in shingles."""
    if stacked or "span" in table.columns:
        return path_common_grams(table, words, separator)
    listed = words.select(F.col("word").alias("token"), F.lit(True).alias("_c")).distinct()
    order = Window.partitionBy("doc_id").orderBy("pos")
    rows = table.join(few(listed), "token", "left").withColumn("_c", F.coalesce("_c", F.lit(False)))
    rows = rows.select("doc_id", "pos", "token", "_c", F.lead("token").over(order).alias("_t"), F.lead("_c").over(order).alias("_n"), F.lead("pos").over(order).alias("_p"))
    pair = F.when((F.col("_p") == F.col("pos") + 1) & (F.col("_c") | F.col("_n")), F.concat_ws(separator, "token", "_t"))
    return rows.withColumn("token", F.explode(F.array_compact(F.array(F.col("token"), pair)))).select("doc_id", "pos", "token")


def common_gram_tokens(df: DataFrame, id_col: str, array: Column, words: DataFrame, separator: str = "_") -> DataFrame:
    """As common_grams of the tokens of a column of token arrays: neighbours stand side by side there, so no token is
    shuffled to find the next one, unless the list of words is too long to be broadcast."""
    beside = F.arrays_zip(array.alias("token"), F.slice(array, F.lit(2), F.greatest(F.size(array), F.lit(1))).alias("next"))
    rows = df.select(F.col(id_col).alias("doc_id"), F.posexplode(beside).alias("pos", "b")).select("doc_id", "pos", F.col("b").getField("token").alias("token"), F.col("b").getField("next").alias("_t"))
    for of, mark in (("token", "_c"), ("_t", "_n")):
        rows = rows.join(few(words.select(F.col("word").alias(of), F.lit(True).alias(mark)).distinct()), of, "left")
    pair = F.when(F.col("_t").isNotNull() & (F.col("_c").isNotNull() | F.col("_n").isNotNull()), F.concat_ws(separator, "token", "_t"))
    return rows.select("doc_id", "pos", F.explode(F.array_compact(F.array(F.col("token"), pair))).alias("token"))


def synonyms(table: DataFrame, rules: DataFrame, expand: bool = True) -> DataFrame:
    """rules (word, synonym): synonyms at the same position, or in place of the word if not `expand`."""
    return synonym_graph(table, rules, expand).select("doc_id", "pos", "token").distinct()


def phrases(table: DataFrame, rules: DataFrame, longest: int | None = None) -> DataFrame:
    """doc_id, pos, synonym, span, path (tokens covered, with their positions) where the words of a rule (word, synonym)
    follow one another on a path of the token graph.

    Rules are followed word by word, so of the paths through stacked tokens only those that begin like a rule are walked.
    """
    graph = _graph(table)
    named = rules.select(F.split("word", " ").alias("_w"), F.col("synonym")).distinct()
    most = longest or named.agg(F.max(F.size("_w"))).first()[0] or 1
    at = lambda pos, token: F.struct(F.col(pos).alias("pos"), F.col(token).alias("token"))
    walks = graph.join(named.withColumn("token", F.col("_w")[0]), "token").select("doc_id", "pos", (F.col("pos") + F.col("span")).alias("_end"), "_w", "synonym", F.array(at("pos", "token")).alias("path"))
    found = None
    for k in range(1, most + 1):
        whole = walks.where(F.size("_w") == k).select("doc_id", "pos", "synonym", (F.col("_end") - F.col("pos")).alias("span"), "path")
        found = whole if found is None else found.unionByName(whole)
        if k < most:
            step = walks.where(F.size("_w") > k).withColumn("_word", F.col("_w")[k]).join(_ahead(graph), (F.col("doc_id") == F.col("_d")) & (F.col("_end") == F.col("_p")) & (F.col("_word") == F.col("_t")))
            walks = step.select("doc_id", "pos", (F.col("_p") + F.col("_n")).alias("_end"), "_w", "synonym", F.concat("path", F.array(at("_p", "_t"))).alias("path"))
    return found


def synonym_graph(table: DataFrame, rules: DataFrame, expand: bool = True, longest: int | None = None) -> DataFrame:
    """doc_id, pos, token, span: rules (word, synonym), of which both may have several words parted by single blanks.

    A synonym stands where its words begin and spans as many positions as they do.  Words are found along all paths
    through stacked tokens.  If not `expand`, the tokens on a path that a match covers go.  `longest` is the most words of a
    rule (counted if not given).
    """
    plain = _graph(table)
    found = phrases(table, rules, longest)
    if not expand:
        covered = found.select("doc_id", F.explode("path").alias("c")).select("doc_id", "c.pos", "c.token").distinct()
        plain = plain.join(covered, ["doc_id", "pos", "token"], "left_anti")
    return plain.unionByName(found.select("doc_id", "pos", F.col("synonym").alias("token"), F.col("span").cast("int").alias("span"))).distinct()


def stem_override(table: DataFrame, rules: DataFrame) -> DataFrame:
    """rules (word, stem)."""
    return table.join(rules.select(F.col("word").alias("token"), F.col("stem").alias("_s")), "token", "left").select("doc_id", "pos", F.coalesce("_s", "token").alias("token"))


def pattern_replace_filter(table: DataFrame, regex: str, replacement: str, everywhere: bool = True) -> DataFrame:
    """On each token; else its first match only."""
    if everywhere:
        return each(table, lambda t: F.regexp_replace(t, regex, replacement))
    return each(table, lambda t: F.regexp_replace(t, f"^(.*?)(?:{regex})", "$1" + replacement))


def pattern_capture(table: DataFrame, patterns: list[str], preserve_original: bool = True) -> DataFrame:
    """One token for each group 1 of each match."""
    found = F.flatten(F.array(*[F.regexp_extract_all("token", F.lit(p), F.lit(1)) for p in patterns]))
    found = F.concat(F.array("token"), found) if preserve_original else found
    return table.withColumn("token", F.explode(_non_empty(F.array_distinct(found))))


def word_delimiter(
    table: DataFrame,
    preserve_original: bool = False,
    catenate_all: bool = False,
    catenate_words: bool = False,
    catenate_numbers: bool = False,
    generate_word_parts: bool = True,
    generate_number_parts: bool = True,
    split_on_case_change: bool = True,
    split_on_numerics: bool = True,
    stem_english_possessive: bool = True,
    protected_words: tuple[str, ...] = (),
) -> DataFrame:
    """Split at marks and, if wanted, at case changes and between letters and digits; all at the token's position.

    A part that begins with a digit is a number part.  Runs of word or number parts are joined by the catenate options.
    Protected words stay whole.
    """
    token = F.col("token")
    text = F.regexp_replace(token, "['’][sS]$", "") if stem_english_possessive else token
    edges = [r"(?<=\p{Ll})(?=\p{Lu})"] * split_on_case_change + [r"(?<=\p{L})(?=\p{N})", r"(?<=\p{N})(?=\p{L})"] * split_on_numerics
    parts = _non_empty(F.split(F.regexp_replace(text, "|".join(edges), " ") if edges else text, r"[^\p{L}\p{N}]+"))

    def number(p: Column) -> Column:
        return p.rlike(r"^\p{N}")

    def runs(wanted: Column) -> Column:
        """Two or more neighbouring parts of a kind, joined: parts of the other kind become the separator."""
        marked = F.array_join(F.transform(parts, lambda p: F.when(number(p) == wanted, p).otherwise(F.lit("\1"))), "\2")
        groups = F.filter(F.split(marked, "\2?\1\2?"), lambda g: g.contains("\2"))
        return F.transform(groups, lambda g: F.replace(g, F.lit("\2"), F.lit("")))

    out = F.filter(parts, lambda p: F.when(number(p), generate_number_parts).otherwise(generate_word_parts))
    if catenate_words:
        out = F.concat(out, runs(F.lit(False)))
    if catenate_numbers:
        out = F.concat(out, runs(F.lit(True)))
    if catenate_all:
        out = F.concat(out, F.array(F.array_join(parts, "")))
    if preserve_original:
        out = F.concat(F.array("token"), out)
    if protected_words:
        out = F.when(token.isin(*protected_words), F.array("token")).otherwise(out)
    return table.withColumn("token", F.explode(_non_empty(F.array_distinct(out))))


def elision(table: DataFrame, articles: list[str]) -> DataFrame:
    """Drop leading articles with an apostrophe."""
    return each(table, lambda t: F.regexp_replace(t, "(?i)^(?:" + "|".join(articles) + ")['’]", ""))


def multiplexer(table: DataFrame, chains: list[Callable[[DataFrame], DataFrame]], preserve_original: bool = True) -> DataFrame:
    """Several chains over the same tokens, merged by position."""
    out = table.select("doc_id", "pos", "token") if preserve_original else None
    for chain in chains:
        one = chain(table).select("doc_id", "pos", "token")
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def condition(table: DataFrame, predicate: Column, fn: Callable[[Column], Column]) -> DataFrame:
    """Apply a scalar filter where a predicate holds."""
    return table.withColumn("token", F.when(predicate, fn(F.col("token"))).otherwise(F.col("token")))


def predicate(table: DataFrame, test: Column) -> DataFrame:
    return table.where(test)


def fingerprint(table: DataFrame, separator: str = " ", max_output_size: int = 255) -> DataFrame:
    """doc_id, fingerprint: sorted distinct tokens; null when longer than the limit."""
    out = table.distinct().groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("token")), separator).alias("fingerprint"))
    return out.withColumn("fingerprint", F.when(F.length("fingerprint") <= max_output_size, F.col("fingerprint")))


def min_hash(table: DataFrame, hashes: int = 16, digest: Callable[..., Column] = F.xxhash64) -> DataFrame:
    """doc_id, seed, value: the least hash (`digest` of token and seed) of the document's tokens under each seed."""
    seeds = F.explode(F.array(*[F.lit(i) for i in range(hashes)])).alias("seed")
    return table.select("doc_id", "token").distinct().select("doc_id", "token", seeds).groupBy("doc_id", "seed").agg(F.min(digest(F.col("token"), F.col("seed"))).alias("value"))


def min_hash_tokens(df: DataFrame, id_col: str, array: Column, hashes: int = 16, digest: Callable[..., Column] = F.xxhash64) -> DataFrame:
    """As min_hash of the tokens of a column of token arrays: the least hashes of a row are found in the row, so what is
    shuffled is a value a row and seed, and no token."""
    def least(seed: int) -> Column:
        return F.struct(F.lit(seed).alias("seed"), F.array_min(F.transform("_tokens", lambda t: digest(t, F.lit(seed)))).alias("value"))

    rows = df.select(F.col(id_col).alias("doc_id"), F.array_distinct(array).alias("_tokens"))
    signed = rows.select("doc_id", F.explode(F.array(*map(least, range(hashes)))).alias("l")).select("doc_id", "l.*").where("value IS NOT NULL")
    return signed.groupBy("doc_id", "seed").agg(F.min("value").alias("value"))


#: Decimal digits of all scripts of the first plane, and their values, by Unicode's properties.
DIGITS = {chr(i): str(unicodedata.decimal(chr(i))) for i in range(128, 0x10000) if unicodedata.category(chr(i)) == "Nd"}


def decimal_digit(c: Column) -> Column:
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(F.translate(c, "".join(DIGITS), "".join(DIGITS.values())))


def apostrophe(c: Column) -> Column:
    """The tail from an apostrophe on is cut."""
    return F.regexp_replace(c, "['’].*$", "")


def classic(c: Column) -> Column:
    """The possessive 's goes, and so do the dots of acronyms."""
    c = F.regexp_replace(c, "['’][sS]$", "")
    return F.when(c.rlike(r"^\p{L}\.(?:\p{L}\.){1,100}\p{L}?$"), F.replace(c, F.lit("."), F.lit(""))).otherwise(c)


def clean(table: DataFrame, stacked: bool = True) -> DataFrame:
    """decimal_digit, classic, apostrophe and remove_duplicates.

    A table that is said not to be `stacked` has one token at a position, as a tokenizer leaves it: each token gives one at
    most, so none can be repeated at its position and the tokens aren't shuffled to look for it.
    """
    cleaned = each(table, lambda t: apostrophe(classic(decimal_digit(t))))
    return unique(cleaned, same_position=True) if stacked else cleaned


def normalise(c: Column) -> Column:
    """The keyword normaliser: lower case, accents folded, trimmed."""
    return F.trim(fold(F.lower(c)))


# ---- analyzers ------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Chain:
    """A custom analyzer: character filters on the column, a tokenizer, and filters on the token table, in this order."""

    tokenizer: Callable[[Column], Column]
    char_filters: tuple[Callable[[Column], Column], ...] = ()
    filters: tuple[Callable[[DataFrame], DataFrame], ...] = ()

    def __call__(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        c = F.col(text_col)
        for f in self.char_filters:
            c = f(c)
        table = tokens(df, id_col, self.tokenizer(c))
        for f in self.filters:
            table = table.transform(f)
        return table


def analyzer(name: str, words: DataFrame | None = None, regex: str = r"\W+") -> Callable[[DataFrame, str, str], DataFrame]:
    """Named chains: standard, simple, whitespace, stop, keyword, pattern, fingerprint (df, id column, text column)."""

    def run(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        c = F.col(text_col)
        array = {"standard": standard(F.lower(c)), "simple": letter(F.lower(c)), "stop": letter(F.lower(c)), "whitespace": whitespace(c), "keyword": keyword(c), "pattern": pattern(F.lower(c), regex), "fingerprint": standard(fold(F.lower(c)))}[name]
        table = tokens(df, id_col, array)
        if name == "stop":
            table = stop(table, words)
        return fingerprint(table) if name == "fingerprint" else table

    return run


def autocomplete_index(df: DataFrame, id_col: str, text_col: str, low: int = 2, high: int = 15, queries: DataFrame | None = None, most: int = 100_000) -> DataFrame:
    """prefix, doc_id: the edge n-grams of lower-case, folded words, each once for a document.

    An index for stated `queries` only holds their words; up to `most` of these are broadcast, so the rest isn't shuffled.
    """
    table = tokens(df, id_col, standard(normalise(F.col(text_col))))
    if queries is None:
        return gram_filter(table, low, high).select(F.col("token").alias("prefix"), "doc_id").distinct()
    wanted = query_words(queries).select("prefix").distinct()
    few = (lambda d: F.broadcast(d)) if wanted.limit(most + 1).count() <= most else (lambda d: d)
    heads = wanted.select(F.substring("prefix", 1, low).alias("_head")).distinct()
    table = table.withColumn("_head", F.substring("token", 1, low)).join(few(heads), "_head", "left_semi")  # before grams are made
    grams = gram_filter(table, low, high).select(F.col("token").alias("prefix"), "doc_id")
    return grams.join(few(wanted), "prefix", "left_semi").distinct()


def query_words(queries: DataFrame) -> DataFrame:
    """query_id, prefix: the words of queries (query_id, text)."""
    return tokens(queries, "query_id", standard(normalise(F.col("text")))).select(F.col("doc_id").alias("query_id"), F.col("token").alias("prefix")).distinct()


def autocomplete(index: DataFrame, queries: DataFrame) -> DataFrame:
    """queries (query_id, text): documents that hold every word of the query as a prefix."""
    wanted = query_words(queries)
    size = wanted.groupBy("query_id").agg(F.count("*").alias("_need"))
    hits = index.join(wanted, "prefix").groupBy("query_id", "doc_id").agg(F.count("*").alias("_have"))
    return hits.join(size, "query_id").where("_have = _need").select("query_id", "doc_id")


def match(table: DataFrame, query_tokens: DataFrame) -> DataFrame:
    """doc_id of documents that hold any query token (column token)."""
    return table.join(query_tokens.select("token").distinct(), "token", "left_semi").select("doc_id").distinct()


def search_as_you_type(table: DataFrame, max_shingle: int = 3, low: int = 1, high: int = 10) -> DataFrame:
    """Shingles, and the prefixes of each shingle's last word with the words before it."""
    grams = shingles(table, 2, max_shingle)
    head, tail = F.regexp_extract("token", "^(.* )?[^ ]*$", 1), F.regexp_extract("token", "([^ ]*)$", 1)
    return grams.select("doc_id", "pos", F.explode(F.transform(ngrams(tail, low, high, True), lambda g: F.concat(head, g))).alias("token"))


def token_count(table: DataFrame) -> DataFrame:
    return table.groupBy("doc_id").agg(F.count("*").alias("n_tokens"))


def statistics(table: DataFrame) -> DataFrame:
    """token, docs, occurrences."""
    return table.groupBy("token", "doc_id").agg(F.count("*").alias("n")).groupBy("token").agg(F.count("*").alias("docs"), F.sum("n").alias("occurrences"))
