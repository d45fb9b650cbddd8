r"""Personal data: patterns, and terms that reveal what the patterns found.

Base spans are e-mail addresses, IP addresses, card numbers (13 to 19 digits that pass Luhn's
check) and telephone numbers, found leftmost and without overlap for each kind.

Further entities are secrets: keys of known form, and long runs of letters with several digits.

Information-theoretic sanitisation: each different value of a base span or secret is a protected
entity e.  From co-occurrence in the lines of the whole corpus, a term t near e (within WINDOW
tokens in the same line, outside e-mail addresses) discloses
PMI(t, e) = log2(N n(t, e) / (n(t) n(e))) of the IC(e) = -log2(n(e) / N) bits that identify e.
What stays hidden is IC - PMI = -log2 P(e | t).  P(e | t) is estimated as
n(t, e) / (n(t) + SMOOTHING), since what stands in few lines says less than what stands in many.
A term that leaves at most `GENERALISE_BITS` is generalised and one that leaves at most
`REMOVE_BITS` is removed, in the documents that name the entity.

Only built-in functions are used.  Positions come from the lengths of the pieces between matches
(`split` and `regexp_extract_all` walk through a text alike), added up in blocks, so the work
follows the length of the text; they count code points, the end is exclusive.

Edge cases: a null text is empty and has no spans; rows are searched one by one and judged by their
own text (`row`, its hash), whatever their ids; ties do not arise, as each term is judged by
itself; an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm.storage import stored

#: fixed values of the contract, in its order.  Possessive repetition and the look-behind change
#: no match: they keep long runs from being tried again from each of their characters.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_DIGITS = "regexp_replace(v, '[^0-9]', '')"
#: every second digit from the right is doubled
_LUHN = f"""pmod(aggregate(sequence(1, length({_DIGITS})), 0, (a, i) -> a +
    if(i % 2 = 1, 1, 2) * cast(substring({_DIGITS}, -i, 1) as int)
    - if(i % 2 = 0 and cast(substring({_DIGITS}, -i, 1) as int) > 4, 9, 0)), 10) = 0"""
VALID = {
    "email": "true",
    "ip": """forall(split(v, '[.]'), x -> length(ltrim('0', x)) < 3
        or length(ltrim('0', x)) = 3 and ltrim('0', x) <= '255')""",
    "card": f"length({_DIGITS}) between 13 and 19 and {_LUHN}",
    "phone": f"length({_DIGITS}) between 9 and 15",
}
TERM = r"\p{L}[\p{L}\p{M}\p{N}]+"
#: keys of known form, or a long run of letters, digits and joints with four digits at least
SECRET = (r"(?<![A-Za-z0-9_-])(?:(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9_-])"
          r"|(?=[A-Za-z0-9_-]{24})(?=[0-9_-]*+[A-Za-z])(?=(?:[A-Za-z_-]*+[0-9]){4})"
          r"[A-Za-z0-9_-]++(?!@))")
LEAST_LETTERS = 3
#: tokens of a line on either side of an entity that count as near it
WINDOW = 16
#: lines without the entity that are supposed beside those in which a term was seen
SMOOTHING = 2
#: matches whose positions are added up at a time
BLOCK = 256
REMOVE_BITS, GENERALISE_BITS = 1.0, 2.0

_SPAN = "struct<kind:string,start:int,end:int,value:string>"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(text: str, pattern: str) -> str:
    """Matches of a pattern in a text as array<struct<start, end, value>>.

    Adding to an array copies it, so matches are gathered in blocks.
    """
    spans = "cast(array() as array<struct<start:int,end:int,value:string>>)"
    block = f"""aggregate(sequence(k * {BLOCK} + 1, least(size(z.found), (k + 1) * {BLOCK})),
        named_struct('at', a.at, 'out', {spans}),
        (b, i) -> named_struct(
          'at', b.at + length(get(z.pieces, i - 1)) + length(get(z.found, i - 1)),
          'out', concat(b.out, array(named_struct(
            'start', b.at + length(get(z.pieces, i - 1)),
            'end', b.at + length(get(z.pieces, i - 1)) + length(get(z.found, i - 1)),
            'value', get(z.found, i - 1))))))"""
    return f"""transform(array(struct(split({text}, {_quoted(pattern)}, -1) as pieces,
          regexp_extract_all({text}, {_quoted(pattern)}, 0) as found)),
        z -> if(size(z.found) = 0, {spans}, aggregate(
          sequence(0, (size(z.found) - 1) div {BLOCK}),
          named_struct('at', 0, 'out', cast(array() as array<array<struct<
            start:int,end:int,value:string>>>)),
          (a, k) -> transform(array({block}),
            x -> named_struct('at', x.at, 'out', concat(a.out, array(x.out))))[0],
          a -> flatten(a.out))))[0]"""


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `text`, `spans` (kind, start, end, value), by kind, then start."""
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(text_col, F.lit("")).alias("text"))
    parts = []
    for kind, pattern in PATTERNS.items():
        hint = "text rlike '[0-9]'" if not _HINTS[kind] else f"contains(text, '{_HINTS[kind]}')"
        if kind == "card":  # a text without 13 digits close together has no card number
            hint = r"text rlike '[0-9](?:[\\x20-]?[0-9]){12}'"
        some = f"{hint} and text rlike {_quoted(pattern)}"
        parts.append(f"""transform(filter(if({some}, {_matches('text', pattern)},
            cast(array() as array<struct<start:int,end:int,value:string>>)),
            s -> {VALID[kind].replace('(v,', '(s.value,')}),
            s -> cast(named_struct('kind', '{kind}', 'start', s.start, 'end', s.end,
                                   'value', s.value) as {_SPAN}))""")
    return rows.withColumn("spans", F.expr(f"concat({', '.join(parts)})"))


#: tokens of a line, in this order: an address hides the words it is made of.  Here an address
#: begins behind other characters only: looked for behind each word, long runs would be read again
_TOKEN = "|".join([rf"(?<![{_LOCAL}])[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
                   SECRET, PATTERNS["phone"], PATTERNS["ip"], PATTERNS["card"], TERM])


def _entities(token: str) -> str:
    """The entities that a token of a line is, or begins with: `kind:value`, lower case."""
    kinds = [*((k, f"{token} rlike {_quoted('^(?:' + p + ')$')}", VALID[k])
               for k, p in PATTERNS.items()),
             ("secret", f"{token} rlike {_quoted('^' + SECRET + '$')}", "true")]
    found = ", ".join(
        f"if({match} and {valid.replace('(v,', f'({token},')}, concat('{kind}:', lower({token})), null)"
        for kind, match, valid in kinds)
    return f"filter(array({found}), e -> e is not null)"


def _mentions(found: DataFrame) -> DataFrame:
    """`entity`, `term`, `place`: the terms near each entity, once for each line it stands in."""
    lines = found.select(F.monotonically_increasing_id().alias("document"),
                         F.posexplode(F.split("text", "\n")).alias("number", "line"))
    apart = f"regexp_replace(line, {_quoted(PATTERNS['email'])}, ' $0 ')"
    tokens = lines.select(
        F.struct("document", "number").alias("place"),
        F.expr(f"regexp_extract_all({apart}, {_quoted(_TOKEN)}, 0)").alias("tokens"))
    # an entity with the tokens around it; the line's other tokens stay behind
    around = tokens.select("place", F.explode(F.expr(f"""filter(transform(tokens, (t, i) ->
        if(t rlike '[0-9@]', struct(t as token, slice(tokens, greatest(i + 2 - {WINDOW}, 1),
           least(i, {WINDOW - 1}) + 1 + {WINDOW}) as near), null)), c -> c is not null)""")).alias("c"))
    near = around.select("place", "c.near", F.explode(F.expr(_entities("c.token"))).alias("entity"))
    return near.select("entity", "place", F.explode("near").alias("token")).select(
        "entity", "place", F.lower("token").alias("term")
    ).where(f"term rlike {_quoted('^' + TERM + '$')} and length(term) >= {LEAST_LETTERS}"
            f" and not term rlike {_quoted('^' + SECRET + '$')}").distinct()


def disclosing_terms(docs: DataFrame, found: DataFrame, smoothing: int = SMOOTHING,
                     generalise_bits: float = GENERALISE_BITS,
                     text_col: str = "text") -> DataFrame:
    """`entity`, `term`, `hidden_bits`, of the terms that reveal an entity.

    `found` are the documents with entities.  Counts are lines of the whole corpus.
    """
    joint = stored(_mentions(found).groupBy("entity", "term").agg(
        F.count("*").alias("joint")), "joint")
    words = docs.select(F.explode(F.split(text_col, "\n")).alias("line")).select(
        F.explode(F.expr(f"""filter(array_distinct(transform(regexp_extract_all(
            line, {_quoted(TERM)}, 0), x -> lower(x))), x -> length(x) >= {LEAST_LETTERS})"""))
        .alias("term"))
    # lines with a term, for all terms; counted in the tasks before the shuffle
    counts = words.groupBy("term").agg(F.count("*").alias("with_term"))
    wanted = joint.select("term").distinct()
    # P(e | t) = n(t, e) / n(t): the number of lines and n(e) cancel in IC - PMI
    return joint.join(counts.join(wanted, "term", "left_semi"), "term").select(
        "entity", "term",
        (F.log2(F.col("with_term") + smoothing) - F.log2("joint")).alias("hidden_bits")
    ).where(F.col("hidden_bits") <= generalise_bits)


def _term_spans(found: DataFrame, terms: DataFrame) -> DataFrame:
    """`row`, `added`: places of the disclosing terms outside the entities, by text."""
    texts = found.dropDuplicates(["row"])
    named = texts.select("row", F.explode(F.concat("spans", "secrets")).alias("s")).select(
        "row", F.concat_ws(":", "s.kind", F.lower("s.value")).alias("entity")).distinct()
    risky = named.join(terms, "entity").groupBy("row", "term").agg(
        F.min("hidden_bits").alias("bits"))
    # words one by one, since a lookup in a map walks through it
    places = texts.join(risky.select("row").distinct(), "row", "left_semi").select(
        "row", F.explode(F.expr(_matches("text", _TOKEN))).alias("w")
    ).select("row", "w", F.lower("w.value").alias("term"))
    return places.join(risky, ["row", "term"]).groupBy("row").agg(F.expr(f"""array_sort(
        collect_list(cast(named_struct(
          'kind', if(bits <= {REMOVE_BITS}, 'removed', 'general'),
          'start', w.start, 'end', w.end, 'value', w.value) as {_SPAN})),
        (x, y) -> x.start - y.start)""").alias("terms"))


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: `doc_id`, `row`, `spans` (base), `added` (secrets, then terms)."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    none = f"cast(array() as array<{_SPAN}>)"
    secrets = F.expr(f"""if(text rlike {_quoted(SECRET)}, transform(
        {_matches('text', SECRET)}, s -> cast(named_struct('kind', 'secret', 'start', s.start,
        'end', s.end, 'value', s.value) as {_SPAN})), {none})""")
    every = stored(base_spans(own).withColumn("secrets", secrets).select(
        "doc_id", F.xxhash64("text").alias("row"), "spans", "secrets",
        F.when(F.size("spans") + F.size("secrets") > 0, F.col("text")).alias("text")), "personal")
    some = every.where("size(spans) + size(secrets) > 0")
    terms = disclosing_terms(own, some)
    placed = stored(_term_spans(some, terms), "terms")
    marked = some.join(placed, "row", "left").select(
        "doc_id", "row", "spans",
        F.concat("secrets", F.coalesce("terms", F.expr(none))).alias("added"))
    return marked.unionByName(every.where("size(spans) + size(secrets) = 0").select(
        "doc_id", "row", "spans", F.expr(none).alias("added")))


def sanitised(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents with base spans as `<kind>`, terms as `<term>` or without them."""
    marks = found.where("size(spans) + size(added) > 0").select(
        F.col("row").alias("_row"), F.expr("""array_sort(transform(concat(spans, added),
            s -> named_struct('start', s.start, 'end', s.end, 'kind', s.kind)))""").alias("_s")
    ).distinct()
    text = F.expr("""if(_s is null, text, aggregate(_s,
        named_struct('at', 0, 'out', ''),
        (a, s) -> if(s.start < a.at, a, named_struct('at', s.end, 'out', concat(a.out,
            substring(text, a.at + 1, s.start - a.at),
            case s.kind when 'removed' then '' when 'general' then '<term>'
                        else concat('<', s.kind, '>') end))),
        a -> concat(a.out, substring(text, a.at + 1))))""")
    out = docs.join(marks, F.xxhash64(docs["text"]) == marks["_row"], "left")
    return out.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])


def op2(spark, sf_dir: str) -> DataFrame:
    found = findings(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def joined(spans: str):
        return F.expr(f"array_join(transform({spans}, "
                      "s -> concat_ws(':', s.kind, s.start, s.end)), ',')")
    return found.select(
        F.col("doc_id"),
        *[F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}")
          for k in PATTERNS],
        F.expr("cast(size(filter(added, s -> s.kind = 'secret')) as bigint)").alias("n_secret"),
        F.expr("size(spans) + size(added) > 0").alias("personal"),
        F.sha2(joined("spans"), 256).alias("base_sha256"),
        joined("concat(spans, added)").alias("spans"),
    )
