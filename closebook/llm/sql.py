r"""Queries of the subpackage in DuckDB SQL, as plain restatements over whole tables.

`r` numbers the rows, since documents may repeat.
"""

from __future__ import annotations

_BLANK_WORDS = r"'[^\x20\x09-\x0D]+'"
_ALPHANUMERIC = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _rows(words: str, lower: bool = True) -> str:
    text = "coalesce(text, '')"
    return (f"SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, "
            f"regexp_extract_all({_lower(text) if lower else text}, {words}) AS w FROM documents")


DECONTAMINATION = f"""
WITH d AS ({_rows(_ALPHANUMERIC)}),
items AS (
    SELECT CAST(item_id AS VARCHAR) AS item,
           regexp_extract_all({_lower("coalesce(text, '')")}, {_ALPHANUMERIC}) AS w
    FROM benchmark WHERE item_id IS NOT NULL),
phrases AS (
    SELECT DISTINCT item, least(len(w), 10) AS n,
           array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS p
    FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s(i) WHERE len(w) > 0),
places AS (
    SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
    FROM d, (SELECT DISTINCT n FROM phrases), unnest(range(1, len(w) - n + 2)) AS s(i)),
found AS (SELECT r, n, i, item FROM places JOIN phrases USING (n, p)),
hit AS (
    SELECT r, count(DISTINCT k) AS n_hit
    FROM (SELECT DISTINCT r, n, i FROM found), unnest(range(i, i + n)) AS s(k) GROUP BY r),
named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

_JUDGED = rf"""
WITH d AS (
    SELECT *, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, {_BLANK_WORDS})] AS l
    FROM ({_rows(_BLANK_WORDS, lower=False)})),
windows AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, p) AS n
    FROM (SELECT r, i, array_to_string(w[i:i + 2], ' ') AS p
          FROM d, unnest(range(1, len(w) - 1)) AS s(i))),
repeated AS (
    SELECT r, count(DISTINCT k) AS n
    FROM windows, unnest(range(i, i + 3)) AS s(k) WHERE n > 1 GROUP BY r),
measured AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
           length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
           coalesce(n, 0) AS n_repeat_words,
           len(l) AS n_lines, length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclamations,
           length(regexp_replace(t, '\P{{L}}', '', 'g')) AS n_letters
    FROM d LEFT JOIN repeated USING (r)),
judged AS (
    SELECT *, CAST(
        CASE WHEN n_words < 50 THEN 1 ELSE 0 END
        + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 100 * n_symbols > 10 * word_chars THEN 4 ELSE 0 END
        + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
        + CASE WHEN 10 * word_chars < 15 * n_words OR word_chars > 20 * n_words
               THEN 16 ELSE 0 END
        + CASE WHEN 100 * n_exclamations > 30 * n_words THEN 32 ELSE 0 END
        + CASE WHEN 100 * n_letters < 50 * word_chars THEN 64 ELSE 0 END AS BIGINT) AS failed
    FROM measured)"""

QUALITY_RULES = rf"""{_JUDGED}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed
FROM judged
"""

#: fixed values: the rules in the order of their bits, and how many of them each policy has
_RULES = ("few_words", "repeated_windows", "symbols", "repeated_lines", "word_length",
          "exclamations", "few_letters")
_POLICIES = {"1": 2, "2": 7}

RULE_ABLATIONS = _JUDGED + "\n" + " UNION ALL ".join(
    f"SELECT '{version}' AS policy, '{rule}' AS rule, "
    f"CAST(coalesce(sum(CASE WHEN failed & {1 << k} <> 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS failing, "
    f"CAST(coalesce(sum(CASE WHEN failed & {(1 << size) - 1} = 0 THEN 1 ELSE 0 END), 0) AS BIGINT) "
    f"AS kept, CAST(coalesce(sum(CASE WHEN failed & {(1 << size) - 1 - (1 << k)} = 0 THEN 1 ELSE 0 "
    f"END), 0) AS BIGINT) AS kept_without FROM judged"
    for version, size in _POLICIES.items() for k, rule in enumerate(_RULES[:size]))

JACCARD_JOIN = f"""
WITH RECURSIVE d AS ({_rows(_BLANK_WORDS)}),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
    FROM d, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id),
links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM d
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
LEFT JOIN sizes USING (doc_id)
"""


def _leaf(n_chars: str) -> str:
    """The hash of a row's fields, each behind its length in bytes."""
    fields = ["doc_id", "source", "lang", n_chars, "text"]
    written = [f"CAST({field} AS VARCHAR)" for field in fields]
    return "sha256(" + " || ".join(
        f"coalesce(strlen({text}) || ':' || {text}, '-')" for text in written) + ")"


#: the checksum's polynomial, bit by bit over the bytes of the id as text
_CRC32 = """xor(list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)],
                [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
    lambda crc, byte: list_reduce(
        list_concat([xor(crc, byte)], [CAST(0 AS BIGINT) FOR k IN range(8)]),
        lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
    4294967295)"""

MERKLE_MANIFEST = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
           CASE WHEN {_CRC32} % 7 = 0 THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END
               AS start
    FROM documents),
placed AS (
    SELECT *, row_number() OVER (
        PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
levels AS (
    SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY lang
    UNION ALL
    SELECT lang, level + 1, [sha256(nodes[2 * k + 1] || coalesce(nodes[2 * k + 2], ''))
                             FOR k IN range((len(nodes) + 1) // 2)]
    FROM levels WHERE len(nodes) > 1),
subroots AS (
    SELECT lang, nodes[1] AS subroot, level AS height,
           row_number() OVER (ORDER BY CAST(coalesce(lang, '') AS BLOB), lang NULLS FIRST) - 1
               AS place
    FROM levels WHERE len(nodes) = 1),
top_levels AS (
    SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
    UNION ALL
    SELECT level + 1, [sha256(nodes[2 * k + 1] || coalesce(nodes[2 * k + 2], ''))
                       FOR k IN range((len(nodes) + 1) // 2)]
    FROM top_levels WHERE len(nodes) > 1),
rows AS (
    SELECT row_number() OVER () AS r, placed.*, subroot, height, place,
           (SELECT nodes[1] FROM top_levels WHERE len(nodes) = 1) AS root
    FROM placed JOIN subroots ON placed.lang IS NOT DISTINCT FROM subroots.lang),
met AS (
    SELECT r, level, coalesce(nodes[xor(pos >> level, 1) + 1], '') AS sibling,
           (pos >> level) & 1 = 1 AS on_left
    FROM rows JOIN levels ON rows.lang IS NOT DISTINCT FROM levels.lang WHERE len(nodes) > 1
    UNION ALL
    SELECT r, height + level, coalesce(nodes[xor(place >> level, 1) + 1], ''),
           (place >> level) & 1 = 1
    FROM rows, top_levels WHERE len(nodes) > 1),
proofs AS (
    SELECT r, string_agg(sibling, '' ORDER BY level) AS proof,
           list({{s: sibling, l: on_left}} ORDER BY level) AS steps FROM met GROUP BY r),
fold AS (
    SELECT r, 0 AS done, start AS own, coalesce(steps, []) AS steps
    FROM rows LEFT JOIN proofs USING (r)
    UNION ALL
    SELECT r, done + 1,
           sha256(CASE WHEN steps[done + 1].l THEN steps[done + 1].s || own
                       ELSE own || steps[done + 1].s END), steps
    FROM fold WHERE done < len(steps))
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256,
       own AS folded_root, own = root AS verified
FROM rows LEFT JOIN proofs USING (r) JOIN fold USING (r) WHERE done = len(fold.steps)
"""

def _phrases(table: str, columns: str, sizes: list[int]) -> str:
    """The contiguous phrases of the word lists `w` of a table, one row each."""
    return " UNION ALL ".join(
        f"SELECT {columns}, {size} AS k, unnest([array_to_string(w[i:i + {size - 1}], ' ') "
        f"FOR i IN range(1, len(w) - {size - 2})]) AS phrase FROM {table}" for size in sizes)


def _cut_phrases(places: list[int]) -> str:
    """Both parts of every candidate, cut behind each of its words but the last."""
    return " UNION ALL ".join(
        f"SELECT lang, phrase, a, {j} AS j, array_to_string(w[1:{j}], ' ') AS head, "
        f"array_to_string(w[{j + 1}:k], ' ') AS rest FROM candidates WHERE k > {j}"
        for j in places)


COLLOCATIONS = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
        {_lower("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
    FROM documents),
phrases AS ({_phrases("pieces", "lang", [1, 2, 3, 4])}),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM phrases GROUP BY lang, k, phrase),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w
    FROM counts WHERE k > 1 AND f >= 30),
swallowed AS (
    SELECT DISTINCT c.lang, c.phrase
    FROM candidates c JOIN (
        {_phrases("candidates", "lang, k AS n_words, a", [2, 3])}) longer
    ON c.lang = longer.lang AND c.phrase = longer.phrase AND longer.k < longer.n_words
    WHERE 100 * CAST(longer.a AS HUGEINT) >= 80 * CAST(c.a AS HUGEINT)),
parted AS ({_cut_phrases([1, 2, 3])}),
cuts AS (
    SELECT p.lang, p.phrase, a, j, x.f AS l, y.f AS r,
           (2000000 * CAST(a AS HUGEINT)) // (CAST(x.f AS HUGEINT) + y.f) AS score
    FROM parted p JOIN counts x ON x.lang = p.lang AND x.phrase = p.head
                  JOIN counts y ON y.lang = p.lang AND y.phrase = p.rest),
scored AS (
    SELECT * FROM cuts ANTI JOIN swallowed USING (lang, phrase)
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (
           PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM scored JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

LINE_DEDUP = r"""
WITH texts AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents),
lines AS (
    SELECT doc_id, CAST(i - 1 AS INTEGER) AS line, list_sort(list_distinct(
        regexp_extract_all(lower(x[i]), '[^\x20\x09-\x0D]+'))) AS w
    FROM texts, unnest(range(1, len(x) + 1)) AS p(i)),
sets AS (
    SELECT w, len(w) AS n, min({'d': doc_id, 'l': line}) AS first,
           row_number() OVER () AS id
    FROM lines WHERE len(w) > 0 GROUP BY w),
words AS (SELECT id, n, unnest(w) AS word FROM sets),
counts AS (SELECT word, count(*) AS c FROM words GROUP BY word),
ranked AS (
    SELECT id, n, word, row_number() OVER (PARTITION BY id ORDER BY c, word) AS p
    FROM words JOIN counts USING (word)),
prefixes AS (SELECT * FROM ranked WHERE p <= n - (80 * n + 99) // 100 + 1),
pairs AS (
    SELECT DISTINCT x.id AS a, y.id AS b
    FROM prefixes x JOIN prefixes y ON x.word = y.word AND x.id <> y.id
    WHERE 100 * x.n >= 80 * y.n AND 100 * y.n >= 80 * x.n),
near AS (
    SELECT DISTINCT a FROM (
        SELECT a, len(list_intersect(x.w, y.w)) AS c, x.n + y.n AS total
        FROM pairs JOIN sets x ON x.id = a JOIN sets y ON y.id = b WHERE y.first < x.first)
    WHERE 100 * c >= 80 * (total - c)),
gone AS (
    SELECT lines.doc_id, lines.line FROM lines JOIN sets USING (w) LEFT JOIN near ON near.a = sets.id
    WHERE near.a IS NOT NULL OR {'d': lines.doc_id, 'l': lines.line} <> sets.first),
by_document AS (
    SELECT doc_id, CAST(count(*) AS INTEGER) AS n, string_agg(line, ',' ORDER BY line) AS removed
    FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(x), 0) AS INTEGER) AS n_lines, coalesce(n, 0) AS n_removed,
       coalesce(removed, '') AS removed
FROM texts LEFT JOIN by_document USING (doc_id)
"""
