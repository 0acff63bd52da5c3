"""DuckDB SQL for the rows of the operators' queries, where SQL can express them, written from the contracts."""

from __future__ import annotations

import string

from vigil.llm import fingerprint, licenses, mixing, quality, suffix

WORD = r"[^\x20\x09-\x0D]+"


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


# Every string of LENGTH bytes, the first place of each, and the bytes that the others cover. Runs of covered bytes are
# merged, and the bytes between them hashed. Bytes are handled as two hex digits each.
SUFFIX = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT doc_id, h, length(h) // 2 AS n FROM d),
p AS (SELECT doc_id, unnest(range(n - {suffix.LENGTH} + 1)) AS p, h FROM n WHERE n >= {suffix.LENGTH}),
s AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 2 * {suffix.LENGTH})) AS s FROM p),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS nth FROM s),
c AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM r WHERE nth > 1),
g AS (SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + {suffix.LENGTH} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM c),
spans AS (SELECT doc_id, g, min(p) AS lo, max(p) + {suffix.LENGTH} AS hi FROM g GROUP BY ALL),
gaps AS (SELECT doc_id, hi AS a, coalesce(lead(lo) OVER (PARTITION BY doc_id ORDER BY lo), n) AS b, h, lo FROM spans JOIN n USING (doc_id)),
heads AS (SELECT doc_id, 0 AS a, min(lo) AS b, any_value(h) AS h FROM gaps GROUP BY doc_id),
parts AS (SELECT doc_id, a, substr(h, 2 * a + 1, 2 * (b - a)) AS x FROM gaps UNION ALL SELECT doc_id, a, substr(h, 1, 2 * b) FROM heads),
kept AS (SELECT doc_id, string_agg(x, '' ORDER BY a) AS h FROM parts GROUP BY doc_id),
sums AS (SELECT doc_id, sum(hi - lo) AS removed, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept.h, n.h))) AS kept_sha256
FROM n LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def tree_sql(text: str) -> str:
    """The fingerprint of a text, level by level, as in the definition."""
    pieces = f"CASE WHEN l = '' THEN [''] ELSE regexp_extract_all(l, {quoted(fingerprint.PIECES)}) END"
    paras = f"list_transform(string_split(s, chr(10)), lambda l: list_transform({pieces}, lambda p: sha256(p)))"
    return f"list_transform(string_split({text}, chr(10) || chr(10)), lambda s: {paras})"


def print_sql(tree: str) -> str:
    joined = "list_aggregate({}, 'string_agg', '')"
    section = joined.format("list_transform(s, lambda ps: sha256(" + joined.format("ps") + "))")
    shown = f"list_aggregate(list_transform({tree}, lambda s: list_aggregate(list_transform(s, lambda ps: list_aggregate(list_transform(ps, lambda p: p[1:8]), 'string_agg', '.')), 'string_agg', ',')), 'string_agg', ';')"
    return f"sha256({joined.format(f'list_transform({tree}, lambda s: sha256({section}))')}) || ':' || {shown}"


LIKENESS = "CASE WHEN {a} = {b} THEN 1.0 ELSE len(list_intersect({x}, {y}))::DOUBLE / greatest(len({x}), len({y})) END"
FINGERPRINTS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id) AS r, count(*) OVER () AS n FROM documents),
e AS (SELECT d.doc_id, d.t, x.t AS nxt, length(d.t) AS n_chars, substr(d.t, 1, length(d.t) - length(d.t) // 4) || substr(x.t, 1, length(d.t) // 4) AS edited
      FROM d JOIN d AS x ON x.r = d.r % d.n + 1),
f AS (SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, {tree_sql('t')} AS tree, {tree_sql('edited')} AS edited_tree, {tree_sql('nxt')} AS next_tree FROM e),
g AS (SELECT doc_id, n_chars, edited_sha256, {print_sql('tree')} AS fingerprint, {print_sql('edited_tree')} AS edited_fingerprint, {print_sql('next_tree')} AS next_fingerprint FROM f),
l AS (SELECT *, list_distinct(regexp_split_to_array(split_part(fingerprint, ':', 2), '[.,;]')) AS a, list_distinct(regexp_split_to_array(split_part(edited_fingerprint, ':', 2), '[.,;]')) AS b,
      list_distinct(regexp_split_to_array(split_part(next_fingerprint, ':', 2), '[.,;]')) AS c FROM g)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, {LIKENESS.format(a='fingerprint', b='edited_fingerprint', x='a', y='b')} AS near_edited,
       {LIKENESS.format(a='fingerprint', b='next_fingerprint', x='a', y='c')} AS near_next
FROM l
"""

# Base32 from hex: four bits a digit, five bits a letter.
WARC = """
WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS s FROM pages),
b AS (SELECT *, list_aggregate(list_transform(string_split(s, ''), lambda c: lpad(bin(instr('0123456789abcdef', c) - 1), 4, '0')), 'string_agg', '') AS bits,
             max(page_id) OVER (PARTITION BY s) AS last FROM d)
SELECT page_id, n AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(list_sum(list_transform(range(5), lambda k: CAST(bits[5 * i + k + 1] AS INTEGER) * (1 << CAST(4 - k AS INTEGER)))) AS BIGINT) + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM b
"""

# The level of the water: with the sources by cap and weight, the first that stays below its cap.
MIXING = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size, ('0x' || substr(md5('42:' || doc_id), 1, 15))::BIGINT AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][(r - 1) % 3 + 1]::DOUBLE AS weight, 2.0 * source_size AS cap, 1.5 * sum(source_size) OVER () AS total FROM s),
o AS (SELECT *, cap / weight AS ratio, total - coalesce(sum(cap) OVER (ORDER BY cap / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(weight) OVER (ORDER BY cap / weight, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM w),
lv AS (SELECT min_by(rest / open, ratio) AS level FROM o WHERE ratio > rest / open),
t AS (SELECT source, source_size, least(cap, coalesce(weight * level, cap))::DOUBLE AS target FROM w, lv),
x AS (SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS whole FROM t),
y AS (SELECT d.*, source_size, target, whole, target - whole * source_size AS extra,
             sum(size) OVER (PARTITION BY d.source ORDER BY (u >> 40) % {mixing.SLICES}, u ROWS UNBOUNDED PRECEDING) AS upto FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source)
SELECT doc_id, size, source_size, target, (size * least(whole + CASE WHEN upto - size / 2 <= extra THEN 1 ELSE 0 END, 2))::BIGINT AS taken FROM y
"""


def licenses_sql() -> str:
    low = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    base = ", ".join(
        f"list_filter(range(len(w)), lambda i: {' AND '.join(f'w[i + {k + 1}] = {quoted(x)}' for k, x in enumerate(p.split()))}) AS p{n}"
        for n, p in enumerate(licenses.PHRASES.values()))
    names = ", ".join(f"CASE WHEN len(p{n}) > 0 THEN {quoted(label)} END" for n, label in enumerate(licenses.PHRASES))
    templates = ", ".join(f"({quoted(label)}, {sorted(set(licenses.words_of(t)))})" for label, t in licenses.TEMPLATES)
    return rf"""
WITH d AS (SELECT doc_id, {low} AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, {word}) AS w FROM d),
p AS (SELECT doc_id, len(w)::BIGINT AS n_words, {base} FROM w),
b AS (SELECT doc_id, n_words, flatten([{', '.join(f'p{n}' for n in range(len(licenses.PHRASES)))}]) AS places, list_sort(list_filter([{names}], lambda x: x IS NOT NULL)) AS base FROM p),
lines AS (SELECT doc_id, list_distinct(regexp_extract_all(line, {word})) AS have FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
tpl AS (SELECT * FROM (VALUES {templates}) AS x(label, want)),
m AS (SELECT doc_id, label, len(list_intersect(have, want))::DOUBLE / len(want) AS met FROM lines, tpl WHERE len(have) > 0 AND len(list_intersect(have, want))::DOUBLE / len(want) >= {licenses.THRESHOLD}),
f AS (SELECT doc_id, list(DISTINCT label) AS found, max(met) AS met FROM m GROUP BY doc_id)
SELECT doc_id, n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word, list_max(places)::BIGINT AS last_word,
       coalesce(array_to_string(base, ','), '') AS base_labels, coalesce(array_to_string(list_sort(list_distinct(list_concat(base, coalesce(found, [])))), ','), '') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(met, 0.0) END AS score
FROM b LEFT JOIN f USING (doc_id)
"""


LICENSES = licenses_sql()


def crc32_sql(x: str) -> str:
    """crc32 of an ASCII text; a column t holds the list of the 256 remainders."""
    step = "xor(t[CAST(xor(c, b) & 255 AS INTEGER) + 1], c >> 8)"
    codes = f"list_prepend(4294967295::BIGINT, list_transform(list_filter(string_split({x}, ''), lambda z: z <> ''), lambda z: ascii(z)::BIGINT))"
    return f"xor(list_reduce({codes}, lambda c, b: {step}), 4294967295::BIGINT)"


def conversations_sql() -> str:
    """The contract's dynamic program, row by row from each conversation's end, with costs, audits and repaired rows by state."""
    def one(cost, edits, rows):
        return f"{{'c': {cost}, 'a': {edits}, 'r': {rows}}}"

    def insert(x, role):
        return one(f"3 + {x}.c", f"'I' || {x}.a", f"chr(10) || '{role}:' || {x}.r")

    def least(*ways):
        return f"list_sort(list_filter([{', '.join(ways)}], lambda w: w.c IS NOT NULL))[1]"

    into = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    keeps = {0: "CASE WHEN i = 's' THEN 1 WHEN i = 'u' THEN 2 END", 1: "CASE WHEN i = 'u' THEN 2 END", 2: "CASE WHEN i = 'a' THEN 3 END", 3: "CASE WHEN i = 'u' THEN 2 END"}
    plain = []
    for s in range(4):
        role, to = into[s]
        kept = f"s[({keeps[s]}) + 1]"
        ways = [one(f"4 + s[{s + 1}].c", f"'D' || s[{s + 1}].a", f"s[{s + 1}].r"),
                one(f"CASE WHEN NOT gone THEN late + {kept}.c END", f"'K' || {kept}.a", f"chr(10) || role || ':' || text || {kept}.r"),
                one(f"CASE WHEN NOT gone THEN 3 + late + s[{to + 1}].c END", f"'R' || s[{to + 1}].a", f"chr(10) || '{role}:' || text || s[{to + 1}].r")]
        plain.append(least(*ways))
    final = []
    for s in range(4):
        role, to = into[s]
        ways = [f"p[{s + 1}]", insert(f"p[{to + 1}]", role)]
        if s < 2:
            ways.append(insert(f"{insert('p[4]', 'assistant')}", "user"))
        final.append(least(*ways))
    end = ", ".join([one("0", "''", "''"), one("6", "'II'", "chr(10) || 'user:' || chr(10) || 'assistant:'"), one("3", "'I'", "chr(10) || 'assistant:'"), one("0", "''", "''")])
    step = "if(c & 1 = 1, xor(3988292384::BIGINT, c >> 1), c >> 1)"
    return f"""
WITH RECURSIVE crc_table AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: {step})) AS t),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS f FROM conversations, crc_table),
d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
      CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS nth FROM k WHERE f <> 0),
o AS (SELECT *, substr(role, 1, 1) AS i, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n, lag(substr(role, 1, 1)) OVER w AS before
      FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text))),
q AS (SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, md5(text) ORDER BY pos) > 1 AS again,
      NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS open FROM o),
u AS (SELECT conv_id, pos, n, i, role, text, blank OR again AS gone, blank, NOT blank AND again AS duplicate, NOT blank AND NOT again AND open AS truncated,
      CASE WHEN NOT blank AND NOT again AND open THEN 3 ELSE 0 END AS late, pos > 1 AND before || i NOT IN ('su', 'ua', 'au') AS illegal, turn FROM q),
dp AS (SELECT DISTINCT conv_id, n AS pos, [{end}] AS s FROM u
       UNION ALL SELECT conv_id, pos, [{', '.join(final)}] AS s FROM (SELECT dp.conv_id, dp.pos - 1 AS pos, [{', '.join(plain)}] AS p
       FROM dp JOIN u ON u.conv_id IS NOT DISTINCT FROM dp.conv_id AND u.pos = dp.pos)),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate,
         count_if(truncated) AS truncated, count_if(illegal) AS illegal FROM u GROUP BY conv_id),
r AS (SELECT conv_id, s[1] AS x FROM dp WHERE pos = 0)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(x.c, 0) AS BIGINT) AS cost, coalesce(x.a, '') AS audit,
       sha256(coalesce(substr(x.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""


CONVERSATIONS = conversations_sql()


def share_sql(n: str, total: str, kept: str) -> str:
    return f"1 + CAST(1000000000::HUGEINT * ({n} + 2) // ({total} + 2 * {kept}) AS BIGINT)"


DIVERGENCE = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS all_n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS kept, sum(all_n) AS total FROM k GROUP BY lang),
g AS (SELECT lang, source, coalesce(total, 0) AS total, coalesce(kept, 0) AS kept FROM (SELECT DISTINCT lang, source FROM d)
      LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source) LEFT JOIN (SELECT lang, kept FROM v) USING (lang)),
p AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, {share_sql('coalesce(n, 0)', 'g.total', 'g.kept')} AS p, {share_sql('k.all_n', 'v.total', 'v.kept')} AS q
      FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 10
"""


def quality_sql() -> str:
    rates = {"symbol_rate": "n_symbols / word_chars", "dup_line_rate": "n_dup_lines / n_lines", "repeat_rate": "n_repeat_words / n_words", "upper_rate": "n_upper / word_chars",
             "chars_per_word": "word_chars / n_words"}
    shares = ", ".join(f"coalesce({x.split(' / ')[0]}::DOUBLE / nullif({x.split(' / ')[1]}, 0), 0) AS {r}" for r, x in rates.items())
    pairs = " UNION ALL ".join(f"SELECT lang, source, '{r}' AS rate, {r} AS value FROM r WHERE NOT base_failed" for r in rates)
    high, slack = ("CASE rate " + " ".join(f"WHEN '{r}' THEN {x[i]}" for r, x in quality.RATES.items()) + " END" for i in (0, 1))

    def fences(name: str, by: str) -> str:
        keys = f"{by}, " if by else ""
        return f"""{name}_b AS (SELECT {keys}rate, bucket, sum(n) AS n FROM b GROUP BY ALL),
        {name}_c AS (SELECT *, sum(n) OVER (PARTITION BY {keys}rate ORDER BY bucket NULLS FIRST) AS cum, sum(n) OVER (PARTITION BY {keys}rate) AS rows,
                     coalesce(pow({1 + quality.STEP}, bucket), 0) AS value FROM {name}_b),
        {name}_q AS (SELECT {keys}rate, any_value(rows) AS rows, min(value) FILTER (WHERE cum >= 0.5 * rows) AS mid, min(value) FILTER (WHERE cum >= {high} * rows) AS high FROM {name}_c GROUP BY ALL),
        {name} AS (SELECT {keys}rate, rows, high + {quality.REACH} * (high - mid) + {slack} AS fence FROM {name}_q)"""

    return f"""
    WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, row_number() OVER () AS k FROM documents),
    w AS (SELECT k, regexp_extract_all(t, '{WORD}') AS w FROM d),
    p AS (SELECT k, unnest(w) AS a, unnest(range(len(w))) AS i FROM w),
    t3 AS (SELECT *, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM p WINDOW o AS (PARTITION BY k ORDER BY i)),
    again AS (SELECT k, i FROM t3 WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY k, a, b, c) > 1),
    hit AS (SELECT k, count(DISTINCT i + x) AS n_repeat_words FROM again, (VALUES (0), (1), (2)) v(x) GROUP BY k),
    l AS (SELECT k, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM d),
    s AS (SELECT d.*, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
          len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
          len(l) AS n_lines, len(regexp_extract_all(t, '[A-Z]')) AS n_upper FROM d JOIN w USING (k) JOIN l USING (k) LEFT JOIN hit USING (k)),
    r AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed, {shares} FROM s),
    b AS (SELECT lang, source, rate, CASE WHEN value > 0 THEN ceil(ln(value) / ln({1 + quality.STEP})) END AS bucket, count(*) AS n FROM ({pairs}) GROUP BY ALL),
    {fences("own", "lang, source")}, {fences("bylang", "lang")}, {fences("everything", "")},
    f AS (SELECT own.lang, own.source, own.rate, CASE WHEN own.rows >= {quality.MIN_GROUP_ROWS} THEN own.fence WHEN bylang.rows >= {quality.MIN_GROUP_ROWS} THEN bylang.fence ELSE everything.fence END AS fence
          FROM own JOIN bylang ON own.lang IS NOT DISTINCT FROM bylang.lang AND own.rate = bylang.rate JOIN everything ON everything.rate = own.rate),
    long AS ({" UNION ALL ".join(f"SELECT k, lang, source, '{r}' AS rate, {r} AS value FROM r" for r in rates)}),
    above AS (SELECT DISTINCT k FROM long JOIN f ON f.lang IS NOT DISTINCT FROM long.lang AND f.source IS NOT DISTINCT FROM long.source AND f.rate = long.rate WHERE value > fence)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND k NOT IN (SELECT k FROM above) AS kept, {", ".join(rates)} FROM r
    """


QUALITY = quality_sql()
