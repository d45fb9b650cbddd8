"""Line deduplication by an exact set-similarity join, in built-in functions only.

A line's tokens are its different words (lower case, white space `[\\x20\\x09-\\x0D]`); other
sizes take shingles of that many words (a shorter line has one token, all its words).  Tokens are
ordered by rarity: occurrences in the whole corpus are counted in `BUCKETS`
hash buckets, and a token ranks by its bucket's count, then by its hash.  Any order gives the same
result; this one keeps common words out of the prefixes.  What the plan carries of it is one
number for each bucket, whatever the size of the corpus.

Two lines with Jaccard similarity t share a token among the first n - ceil(t n) + 1 of each.
Candidates are lines that share such a token and pass the length filter, the positional filter
(what can still be common from that token on) and a filter on the parity of their tokens' hash
bits, since a token that only one of two lines has turns one of 64 or 128 bits.  All of them are
verified on their words.  A line is removed if an earlier line, by document id, hash of the text
and line number, is that similar, whether that one is removed or not.

Equal lines (after lower case and white space) are one line in all this, by 128 bits of hash.
Before the prefix join each line meets the earliest `LEADERS` that have the same two smallest, or
the same two greatest, hashes of tokens.  This removes nearly all near copies of one line in linear
time; the prefix join then leaves out pairs whose later line is gone already, and finds all the
rest.  Which line is later it tells from numbers that ascend with the document ids; pairs of equal
numbers stay in unless both lines are gone.

Edge cases: null and empty texts have no lines; lines without a word are never removed; rows of equal
id and text count as one document, other rows that share an id, or have none, are told apart by the
hash of their text; a null id sorts first; an empty table gives an empty result; a removed line takes
its line end along; other columns, whatever their names, pass unchanged; ids may be numbers or text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StringType

from closebook.llm.storage import WorkingTables, stored

SHINGLE_WORDS = 5
#: the size that the operator uses: words
TOKEN_WORDS = 1
PERCENT = 80

#: counts that the order of tokens goes by; a power of two
BUCKETS = 1 << 18
#: buckets whose counts share a row
SHARED = 4
#: earlier lines, of as many shares of the lines, that a line meets by each pair of hashes
LEADERS = 8
#: lines of more tokens have 128 bits of parity, others 64
WIDE = 64
#: candidate pairs or lines, counted, up to which line numbers are broadcast to find the lines
FEW_PAIRS = 1 << 20

_BLANK = r"[\x20\x09-\x0D]"
#: a blank that is no space, or a space before another
_ODD = r"[\x20\x09-\x0D](?:(?<!\x20)|(?=\x20))"
_WORD = r"[^\x20\x09-\x0D]"
_PLACE = ["doc", "version", "line"]
#: what bounds in doubles are loosened by
_LOOSE = "1e-6D"


def _all_tokens(size: int) -> str:
    """The tokens of a line `t` whose words stand one blank apart, with repetitions."""
    if size == 1:
        return "split(t, ' ')"
    # the words are bound once, not split again for each shingle
    return f"""flatten(transform(array(split(t, ' ')), w -> transform(
        sequence(1, greatest(size(w) - {size - 1}, 1)),
        i -> array_join(slice(w, i, {size}), ' '))))"""


def _hashes(size: int) -> Column:
    """The hashes of a line's tokens; different tokens of equal hash count as one in the filters."""
    return F.array_distinct(F.transform(F.expr(_all_tokens(size)), lambda x: F.xxhash64(x)))


def _could_be_similar(percent: int, n: str = "n", m: str = "m") -> str:
    """The filter on lengths, and on the bits in which two lines differ.

    These have the parity of n + m, so that n + m - 2 need(n, m) can be left unrounded.  Doubles
    have no overflow to be checked for each pair.
    """
    low, high = "x.low ^ y.low", "x.high ^ y.high"
    return (f"100D * {n} >= {percent}D * {m} and 100D * {m} >= {percent}D * {n} "
            f"and if({n} > {WIDE} and {m} > {WIDE}, 1D * bit_count({low}) + bit_count({high}), "
            f"bit_count({low} ^ {high})) <= (1D * {n} + {m}) * {(100 - percent) / (100 + percent)}D "
            f"+ {_LOOSE}")


def _ranks(docs: DataFrame, size: int, text_col: str) -> str:
    """For each bucket the rank of its count (thirds of its logarithm), comma-joined."""
    if size == 1:
        # whole texts, since words do not cross lines; rare white space only alters the order
        tokens = docs.select(F.explode(F.split(
            F.replace(F.lower(text_col), F.lit("\n"), F.lit(" ")), " ")).alias("token"))
    else:
        tokens = docs.select(F.explode(F.split(F.lower(text_col), "\n")).alias("t")).select(
            F.explode(F.expr(_all_tokens(size))).alias("token"))
    rows = BUCKETS // SHARED
    hashed = tokens.select(F.xxhash64("token").alias("h"))
    counts = hashed.groupBy(F.expr(f"h & {rows - 1}").alias("id")).agg(*[
        F.count_if(F.expr(f"h & {BUCKETS - rows} = {k * rows}")).alias(f"c{k}")
        for k in range(SHARED)])
    every = docs.sparkSession.range(rows).join(counts, "id", "left").select("id", *[
        F.expr(f"least(cast(3 * log2(greatest(coalesce(c{k}, 1), 1)) as int), 126)").alias(f"r{k}")
        for k in range(SHARED)])
    parts = ", ".join(f"transform(s, x -> x.r{k})" for k in range(SHARED))
    return every.agg(F.array_sort(F.collect_list(F.struct("*"))).alias("s")).select(F.expr(
        f"array_join(flatten(array({parts})), ',')").alias("ranks")).first()["ranks"]


def _different(docs: DataFrame, ranks: str, size: int, percent: int, id_col: str,
               text_col: str) -> DataFrame:
    """One row for each different line: first place, words, sums of its tokens and its prefix."""
    lines = docs.select(
        F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("version"),
        F.posexplode(F.split(text_col, "\n")).alias("line", "t"))
    low = lines.where(F.col("t").rlike(_WORD)).withColumn("t", F.lower("t"))
    plain = low.withColumn("t", F.trim(F.when(
        F.col("t").rlike(_ODD), F.regexp_replace("t", _BLANK + "+", " ")).otherwise(F.col("t"))))
    first = plain.groupBy(F.xxhash64("t").alias("k1"), F.xxhash64(F.lit(1), "t").alias("k2")).agg(
        F.min(F.struct(*_PLACE, "t")).alias("s")).select("s.*")
    hashed = first.withColumn("hashes", F.sort_array(_hashes(size))).withColumn(
        "n", F.size("hashes"))
    # of many hashes the negative ones turn the bits of a second number; each is met once
    parted = hashed.withColumn("below", F.expr(f"""if(n > {WIDE},
        cast(array_position(sort_array(concat(hashes, array(0L))), 0L) as int) - 1, 0)"""))
    bits = "aggregate({}, 0L, (a, h) -> a ^ shiftleft(1L, cast(h & 63 as int)))"
    low = f"""if(n > {WIDE}, {bits.format('slice(hashes, below + 1, n - below)')},
        {bits.format('hashes')})"""
    high = f"if(n > {WIDE}, {bits.format('slice(hashes, 1, below)')}, 0L)"
    order = F.split(F.lit(ranks), ",").cast("array<bigint>")
    # numbers that are never null are sorted without boxes
    tokens = F.sort_array(F.transform("hashes", lambda h: F.shiftleft(F.coalesce(
        order[h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")], F.lit(0).cast("bigint")), 56).bitwiseOR(
            h.bitwiseAND(F.lit((1 << 56) - 1)))))
    return parted.select(
        F.monotonically_increasing_id().alias("num"), *_PLACE, "t", "n",
        F.expr(low).alias("low"), F.expr(high).alias("high"),
        F.expr("xxhash64(get(hashes, 0), get(hashes, 1))").alias("least"),
        F.expr("xxhash64(get(hashes, n - 1), get(hashes, n - 2))").alias("greatest"),
        F.slice(tokens, F.lit(1), F.expr(f"n - ({percent} * n + 99) div 100 + 1").cast("int"))
        .alias("prefix"))


def _turn(doc_type: DataType) -> Column:
    """A number that never falls as ids ascend; ids of other types all have the same."""
    if isinstance(doc_type, IntegralType):
        turn = F.col("doc").cast("bigint")
    elif isinstance(doc_type, StringType):
        # the first seven bytes
        turn = F.expr("""cast(conv(rpad(hex(substring(cast(doc as binary), 1, 7)), 14, '0'), 16, 10)
            as bigint)""")
    else:
        turn = F.lit(0).cast("bigint")
    return F.coalesce(turn, F.lit(-1 << 63))


def _prefixes(different: DataFrame, gone: DataFrame) -> DataFrame:
    """`key`, `low`, `num`, `high`, `turn`, `shape`: the prefix tokens of every line.

    `shape` holds the number of tokens, the place of this one, and whether the line is gone.
    """
    gone = gone.withColumn("gone", F.lit(1))
    if gone.count() <= FEW_PAIRS:
        # the lines with their prefixes are not moved
        gone = F.broadcast(gone)
    marked = different.join(gone, "num", "left")
    placed = marked.select("num", "n", "gone", "low", "high",
                           _turn(different.schema["doc"].dataType).alias("turn"),
                           F.posexplode("prefix").alias("p", "key"))
    return placed.select(F.hash("key").alias("key"), "low", "num", "high", "turn", F.expr(
        "shiftleft(cast(n as bigint), 32) | shiftleft(cast(p as bigint), 1) "
        "| coalesce(gone, 0)").alias("shape"))


def _stars(different: DataFrame, percent: int) -> DataFrame:
    """Pairs `a`, `b` of a line and the earliest ones with the same extreme hashes.

    A key's lines are dealt into `LEADERS` shares, and the earliest of each share leads.
    """
    keyed = different.select(F.explode(F.array("least", "greatest")).alias("key"), "num", "n",
                             "low", "high", F.struct(*_PLACE).alias("at"))
    leaders = keyed.groupBy("key", F.expr(f"num % {LEADERS}")).agg(
        F.min(F.struct("at", "num", "n", "low", "high")).alias("s")).select("key", "s.*")
    return keyed.alias("x").join(leaders.hint("shuffle_hash").alias("y"), "key").where(
        f"y.at < x.at and {_could_be_similar(percent, 'x.n', 'y.n')}").select(
            F.col("x.num").alias("a"), F.col("y.num").alias("b")).distinct()


def _sides(prefixes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows as those that ask and those that are asked, both with the `band` they meet in.

    `n` is the number of tokens, `rest` of those from this one on, `gone` 1 or 0.  A line asks in
    the bands of all sizes that it can be similar to, its own the greatest.  Of the shorter line
    a token among the first m - need(m, m) + 1 is shared already, so that it is asked, in its own
    band, for these only.  Bands are dealt after the exchange, which both read.
    """
    rows = prefixes.repartition("key").select("*", F.expr("cast(shape >> 32 as double)").alias("n"))
    rows = rows.select("key", "low", "num", "high", "turn", "n", F.expr("shape & 1").alias("gone"),
                       F.expr("n - ((shape >> 1) & 2147483647)").alias("rest"))
    least, own = f"cast(3 * log2({percent / 100}D * n) as int)", "cast(3 * log2(n) as int)"
    need = f"{2 * percent / (100 + percent)}D * n - {_LOOSE}"
    asking = rows.select("*", F.explode(F.expr(f"sequence({least}, {own})")).alias("band"))
    asked = rows.select("*", F.explode(F.expr(
        f"if(rest >= {need}, sequence({own}, {own}), null)")).alias("band"))
    return asking, asked


def _meetings(prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs `a`, `b` of lines that share a prefix token and pass the filters.

    Pairs whose later line is gone, or both, are left out.
    """
    asking, asked = _sides(prefixes, percent)
    # two numbers of four bytes are one of eight in a hash join
    return asking.alias("x").join(
        asked.hint("shuffle_hash").alias("y"),
        (F.col("x.key") == F.col("y.key")) & (F.col("x.band") == F.col("y.band"))).where(
        f"(x.n > y.n or x.n = y.n and x.num > y.num) "
        f"and {_could_be_similar(percent, 'x.n', 'y.n')} "
        f"and (x.gone = 0 or x.turn <= y.turn and y.gone = 0) "
        f"and (y.gone = 0 or y.turn <= x.turn) and least(x.rest, y.rest) "
        f">= (x.n + y.n) * {percent / (100 + percent)}D - {_LOOSE}").select(
            F.col("x.num").alias("a"), F.col("y.num").alias("b")).distinct()


def _later(pairs: DataFrame, different: DataFrame, size: int, percent: int) -> DataFrame:
    """`num` of the later line of each pair whose tokens are similar indeed.

    Only the lines of the pairs are moved, and the two of a pair meet in one group.
    """
    sides = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("num"))
    nums = sides.select("num").distinct()
    if pairs.count() <= FEW_PAIRS:
        nums = F.broadcast(nums)
    lines = different.join(nums, "num", "left_semi").select(
        "num", F.struct(*_PLACE).alias("at"), "t")
    both = sides.join(lines, "num").groupBy(
        "a", "b").agg(F.array_sort(F.collect_list(F.struct("at", "num", "t"))).alias("s"))
    words = both.select(F.expr("s[1].num").alias("num"), F.expr("s[0].t").alias("t"),
                        F.expr("s[1].t").alias("t2"))
    x, y = _all_tokens(size), _all_tokens(size).replace("(t,", "(t2,")
    # what both have, of what either has; a filter makes a column anew wherever it names it
    return words.where(f"100 * size(array_intersect({x}, {y})) "
                       f">= {percent} * size(array_union({x}, {y}))").select("num").distinct()


def _kept(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """`doc`, `version`, `kept`: the lines with a word that stay, by document; stored."""
    with WorkingTables(docs.sparkSession) as work:
        ranks = _ranks(docs, size, text_col)
        # hardly a value comes twice
        different = work.stored(_different(docs, ranks, size, percent, id_col, text_col), "lines",
                                **{"parquet.enable.dictionary": "false"})
        stars = work.stored(_stars(different, percent), "stars")
        gone = work.stored(_later(stars, different, size, percent), "gone")
        pairs = work.stored(_meetings(_prefixes(different, gone), percent), "pairs",
                            as_they_lie=True)
        near = work.stored(_later(pairs, different, size, percent), "near")
        left = different.join(gone, "num", "left_anti").join(near, "num", "left_anti")
        return stored(left.groupBy("doc", "version").agg(F.collect_list("line").alias("kept")),
                      "kept")


def free_names(columns: Iterable[str], *names: str) -> list[str]:
    """Column names like `names` that the table does not have."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


def _with_kept(docs: DataFrame, rows: DataFrame, size: int, percent: int, id_col: str,
               text_col: str, version: str, kept: str) -> DataFrame:
    """`rows`, which have the hash of their text as `version`, with the lines `kept` of each."""
    doc, other = free_names([*rows.columns, kept], "doc", "its_version")
    found = _kept(docs, size, percent, id_col, text_col).toDF(doc, other, kept)
    return rows.join(found, rows[id_col].eqNullSafe(F.col(doc)) & (F.col(version) == F.col(other)),
                     "left").drop(doc, other)


def _worded(text: str) -> str:
    """The numbers of the lines that have a word."""
    return (f"filter(transform(split({text}, '\n'), (x, i) -> if(x rlike r'{_WORD}', i, -1)), "
            "i -> i >= 0)")


def removed(docs: DataFrame, size: int = TOKEN_WORDS, percent: int = PERCENT,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, `n_lines`, and `removed`, the numbers of its removed lines."""
    lines = docs.select(
        id_col, F.xxhash64(text_col).alias("version"),
        F.expr(f"coalesce(size(split(`{text_col}`, '\n')), 0)").alias("n_lines"),
        F.expr(f"coalesce({_worded(f'`{text_col}`')}, array())").alias("worded"))
    found = _with_kept(docs, lines, size, percent, id_col, text_col, "version", "kept")
    return found.select(id_col, "n_lines", F.expr(
        "array_except(worded, coalesce(kept, array()))").alias("removed"))


def removed_lines(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc`, `line`: the lines to remove."""
    return removed(docs, size, percent, id_col, text_col).select(
        F.col(id_col).alias("doc"), F.explode("removed").alias("line"))


def deduplicate(docs: DataFrame, size: int = TOKEN_WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents without the removed lines; other columns as they are.

    `text` is replaced; documents without a removed line keep theirs byte for byte.
    """
    version, kept = free_names(docs.columns, "version", "kept")
    rows = docs.withColumn(version, F.xxhash64("text"))
    found = _with_kept(docs, rows, size, percent, "doc_id", "text", version, kept)
    gone = f"array_except({_worded('text')}, coalesce({kept}, array()))"
    # array_except is linear, and the lines are bound once
    text = F.expr(f"""get(transform(array(split(text, '\\n')), x -> array_join(transform(
        array_except(sequence(0, size(x) - 1), {gone}), i -> get(x, i)), '\\n')), 0)""")
    return found.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`")
                          for c in docs.columns])


def op9(spark, sf_dir: str) -> DataFrame:
    return removed(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_lines", F.size("removed").alias("n_removed"),
        F.array_join("removed", ",").alias("removed"))
