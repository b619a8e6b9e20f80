"""Registered queries of this folder and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom.llm.bpe import encode_decode
from rasterloom.llm.collocations import collocations
from rasterloom.llm.common import table, vocabulary
from rasterloom.llm.decontaminate import contamination
from rasterloom.llm.hnsw import nearest
from rasterloom.llm.jaccard import similar
from rasterloom.llm.lexical import search
from rasterloom.llm.pii import find
from rasterloom.llm.quality import score, train
from rasterloom.llm.quotes import conversations, quoting
from rasterloom.llm.simhash import near_duplicates
from rasterloom.llm.token_counts import count_tokens
from rasterloom.llm.toxicity import grade
from rasterloom.llm.toxicity import train as train_toxicity
from rasterloom.llm.url_filter import APART, DEPTH, PRIOR, REJECT, RULES, SHARE, SMOOTH, SUPPORT, judge


def op1_url_filter(spark, sf_dir):
    """Host, path, rule and verdict of every page."""
    return judge(table(spark, sf_dir, "pages"))


def op2_toxicity(spark, sf_dir):
    """Expected severity and grade of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return grade(docs, train_toxicity(docs, table(spark, sf_dir, "labels")))


def op3_simhash(spark, sf_dir):
    """Fingerprint and near-duplicate group of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_nearest(spark, sf_dir):
    """The 20 nearest vectors of every twentieth one."""
    return nearest(table(spark, sf_dir, "embeddings"))


def op5_quotes(spark, sf_dir):
    """The conversations as mail that quotes what it answers, linked and ordered by replies, without the quotes."""
    found = conversations(quoting(table(spark, sf_dir, "conversations")))
    return found.withColumn("links", F.array_join("links", ","))


def op6_quality(spark, sf_dir):
    """Quality score of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op7_bpe(spark, sf_dir):
    """Encode and decode every text; ids and decoded bytes as digests."""
    coded = encode_decode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_decontaminate(spark, sf_dir):
    """Words of every document that lie in windows of benchmark items."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination(docs, items).drop("key")


def op9_token_counts(spark, sf_dir):
    """Bytes and tokens of every text, and which are over the limit."""
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), limit=512)


def op10_pii(spark, sf_dir):
    """Counts and spans of personal data in every text."""
    return find(table(spark, sf_dir, "documents")).drop("n_context")


def op11_jaccard(spark, sf_dir):
    """Number of shingles and component of like shingle sets of every document."""
    return similar(table(spark, sf_dir, "documents"))


def op12_collocations(spark, sf_dir):
    """The 2,000 phrases of two or three words that stick together most, for each language."""
    return collocations(table(spark, sf_dir, "documents"))


def op13_lexical(spark, sf_dir):
    """The 50 documents that score highest for each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_toxicity": op2_toxicity,
    "op3_simhash": op3_simhash,
    "op4_nearest": op4_nearest,
    "op5_quotes": op5_quotes,
    "op6_quality": op6_quality,
    "op7_bpe": op7_bpe,
    "op8_decontaminate": op8_decontaminate,
    "op9_token_counts": op9_token_counts,
    "op10_pii": op10_pii,
    "op11_jaccard": op11_jaccard,
    "op12_collocations": op12_collocations,
    "op13_lexical": op13_lexical,
}

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


def _url_sql() -> str:
    """The rules and the tree of ``judge``."""
    suffix = "CASE " + " ".join(
        f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN ['{h}{p}', '{v}']"
        for h, p, v in sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    )
    levels = "".join(
        f"""
        n{k} AS (SELECT host, template, segs[{k + 1}] AS seg, sum(n) AS n, sum(labelled) AS labelled, sum(blocked) AS blocked
                 FROM t{k} WHERE len(segs) > {k} GROUP BY ALL),
        k{k} AS (SELECT *, CASE WHEN labelled > 0 THEN blocked / labelled END AS rate
                 FROM (SELECT *, sum(n) OVER (PARTITION BY host, template) AS whole FROM n{k})
                 WHERE seg NOT IN ('*', '**') AND n >= {SUPPORT} AND n >= {SHARE} * whole),
        l{k} AS (SELECT *, lag(labelled) OVER w AS m, lag(blocked) OVER w AS b, lag(rate) OVER w AS r
                 FROM k{k} WINDOW w AS (PARTITION BY host, template, labelled > 0 ORDER BY rate, seg)),
        d{k} AS (SELECT *, (blocked + b) / (labelled + m) AS pooled FROM l{k}),
        p{k} AS (SELECT *, sum(CASE WHEN rate - r > {APART} * sqrt(pooled * (1 - pooled) * (1 / labelled + 1 / m)) THEN 1 ELSE 0 END)
                   OVER (PARTITION BY host, template, labelled > 0 ORDER BY rate, seg) AS part FROM d{k}),
        b{k} AS (SELECT host, template, seg, min(seg) OVER g || CASE WHEN count(*) OVER g > 1 THEN '|+' || (count(*) OVER g - 1) ELSE '' END AS branch
                 FROM p{k} WINDOW g AS (PARTITION BY host, template, labelled > 0, part)),
        t{k + 1} AS MATERIALIZED (SELECT t{k}.host, segs, n, labelled, blocked,
                       t{k}.template || CASE WHEN len(segs) > {k} THEN '/' || coalesce(branch, '*') ELSE '' END AS template,
                       CASE WHEN len(segs) > {k} THEN (sum(blocked) OVER w + {SMOOTH}::DOUBLE * purity) / (sum(labelled) OVER w + {SMOOTH}::DOUBLE)
                            ELSE purity END AS purity
                     FROM t{k} LEFT JOIN b{k} ON t{k}.host = b{k}.host AND t{k}.template = b{k}.template AND segs[{k + 1}] = seg
                     WINDOW w AS (PARTITION BY t{k}.host, t{k}.template, len(segs) > {k}, coalesce(branch, '*'))),"""
        for k in range(DEPTH + 1)
    )
    return f"""
        WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
        u AS (SELECT *, {suffix} END AS says,
                     list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''),
                       lambda s: CASE WHEN regexp_matches(s, '[0-9]') OR length(s) >= 40 THEN '*' ELSE s END) AS named FROM h),
        v AS MATERIALIZED (SELECT *, CASE WHEN len(named) > {DEPTH} THEN named[1:{DEPTH}] || ['**'] ELSE named END AS segs FROM u),
        g AS (SELECT host, segs, count(*) AS n, count(says) AS labelled, count(*) FILTER (says[2] = 'block') AS blocked
              FROM v GROUP BY host, segs),
        t0 AS MATERIALIZED (SELECT *, '' AS template,
                 (sum(blocked) OVER h + {SMOOTH}::DOUBLE * {PRIOR}::DOUBLE) / (sum(labelled) OVER h + {SMOOTH}::DOUBLE) AS purity
               FROM g WINDOW h AS (PARTITION BY host)),{levels}
        z AS (SELECT host, segs, template, purity FROM t{DEPTH + 1})
        SELECT page_id, v.host, path, says[1] AS rule, template, purity,
               coalesce(says[2], CASE WHEN purity >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict
        FROM v JOIN z ON v.host = z.host AND v.segs = z.segs"""


_MAIL = """
        o AS (SELECT *, coalesce(text, '') AS t FROM conversations),
        w AS (SELECT *, lag(turn) OVER c AS last, lag(t, 1) OVER c AS b1, lag(t, 2) OVER c AS b2, lag(t, 3) OVER c AS b3, lag(t, 4) OVER c AS b4
              FROM o WINDOW c AS (PARTITION BY conv_id ORDER BY turn, t)),
        q AS (SELECT *, concat_ws(chr(10) || chr(10),
                '>> ' || replace(CASE WHEN turn % 6 = 0 THEN b2 END, chr(10), chr(10) || '>> '),
                '> ' || replace(regexp_replace(CASE turn % 3 WHEN 0 THEN b1 WHEN 1 THEN b2 ELSE b3 END, '^([^ \\n]+ [^ \\n]+) ', '\\1' || chr(10)), chr(10), chr(10) || '> '),
                '> ' || replace(CASE WHEN turn % 4 = 3 THEN b4 END, chr(10), chr(10) || '> '),
                CASE WHEN turn % 5 = 2 THEN '> Nobody here wrote this.' END) AS parts FROM w),
        m AS MATERIALIZED (SELECT conv_id, turn, role, last, t,
                CASE WHEN parts = '' THEN t ELSE 'A message wrote:' || chr(10) || parts || chr(10) || chr(10) || t END AS mail FROM q),"""

ORACLES: dict[str, str] = {
    "op1_url_filter": _url_sql(),
    "op5_quotes": f"""
        WITH RECURSIVE {_MAIL}
        x AS (SELECT conv_id, turn, unnest(range(1, len(a) + 1)) AS i, a FROM (SELECT *, string_split_regex(mail, '\\r\\n|\\r|\\n') AS a FROM m)),
        l AS (SELECT conv_id, turn, i, len(regexp_replace(regexp_extract(a[i], '^((?:[ \\t]*>)+)', 1), '[ \\t]', '', 'g')) AS level,
                     trim(regexp_replace({_LOWER.replace("coalesce(text, '')", "regexp_replace(a[i], '^((?:[ \t]*>)+)', '')")}, '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS line FROM x),
        n AS (SELECT *, CASE WHEN level IS DISTINCT FROM lag(level) OVER c OR lag(line) OVER c = '' THEN 1 ELSE 0 END AS starts
              FROM l WINDOW c AS (PARTITION BY conv_id, turn ORDER BY i)),
        p AS (SELECT *, sum(starts) OVER (PARTITION BY conv_id, turn ORDER BY i) AS part FROM n),
        r AS MATERIALIZED (SELECT *, string_agg(line, ' ' ORDER BY i) OVER (PARTITION BY conv_id, turn, part ORDER BY i
                ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS whole FROM p WHERE line <> ''),
        g AS (SELECT DISTINCT conv_id, turn, unnest([line, whole]) AS s FROM r WHERE level = 0),
        f AS (SELECT r.conv_id, r.turn, r.i, any_value(r.level) AS level, max(y.turn) AS own, max(z.turn) AS whole
              FROM r LEFT JOIN g AS y ON y.conv_id = r.conv_id AND y.s = r.line AND y.turn < r.turn
                     LEFT JOIN g AS z ON z.conv_id = r.conv_id AND z.s = r.whole AND z.turn < r.turn
              WHERE r.level > 0 GROUP BY ALL),
        k AS (SELECT conv_id, turn, level, coalesce(whole, own) AS source, count(*) AS lines FROM f GROUP BY ALL),
        s AS (SELECT conv_id, turn, sum(lines) AS n_quoted, coalesce(sum(lines) FILTER (source IS NOT NULL), 0) AS n_linked, max(level) AS deepest,
                     max([lines, source]) FILTER (level = 1 AND source IS NOT NULL) AS best,
                     string_agg(level || ':' || coalesce(source::VARCHAR, '-') || ':' || lines, ',' ORDER BY level || ':' || coalesce(source::VARCHAR, '-') || ':' || lines) AS links
              FROM k GROUP BY ALL),
        u AS MATERIALIZED (SELECT m.*, coalesce(best[2], last) AS up, n_quoted, n_linked, deepest, links FROM m LEFT JOIN s USING (conv_id, turn)),
        d AS (SELECT conv_id, turn, turn AS root, 0::BIGINT AS depth FROM u WHERE up IS NULL
              UNION ALL SELECT u.conv_id, u.turn, d.root, d.depth + 1 FROM u JOIN d ON u.conv_id = d.conv_id AND u.up = d.turn)
        SELECT conv_id, turn, role, up AS reply_to, depth, root, coalesce(n_quoted, 0)::BIGINT AS n_quoted, coalesce(n_linked, 0)::BIGINT AS n_linked,
               coalesce(deepest, 0)::BIGINT AS deepest, coalesce(links, '') AS links, rtrim(t) AS text
        FROM u JOIN d USING (conv_id, turn)""",
    "op8_decontaminate": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        i AS (SELECT item_id, w, least(len(w), 13) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
        g AS (SELECT DISTINCT item_id, n, array_to_string(w[a:a + n - 1], ' ') AS gram
              FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS a FROM i)),
        s AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS a
              FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n),
        h AS (SELECT doc_id, a, g.n, item_id FROM s JOIN g ON s.n = g.n AND array_to_string(w[a:a + s.n - 1], ' ') = gram),
        c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + n)) AS p FROM h) GROUP BY 1),
        t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY 1)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit > 0 AND 20 * n_hit >= len(w), FALSE) AS contaminated
        FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op12_collocations": f"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex(piece, '[ \\t]+') AS w
                   FROM (SELECT lang, trim(unnest(string_split_regex({_LOWER}, '[.,;:!?\\n\\x0B\\f\\r]')), chr(32) || chr(9)) AS piece FROM documents)
                   WHERE piece <> ''),
        s AS (SELECT lang, k, w[i:i + k - 1] AS g
              FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)),
        f AS (SELECT lang, k, g, count(*)::BIGINT AS n FROM s GROUP BY ALL),
        t AS (SELECT lang, sum(n)::BIGINT AS total FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT * FROM f WHERE k > 1 AND n >= 10),
        u AS (SELECT c.lang, c.g, c.n AS a, x.n AS l, y.n AS r, x.k AS cut,
                     (1000000::HUGEINT * c.n * c.n // (x.n::HUGEINT * y.n))::BIGINT AS score
              FROM c JOIN f AS x ON x.lang = c.lang AND x.k < c.k AND x.g = c.g[1:x.k]
                     JOIN f AS y ON y.lang = c.lang AND y.k = c.k - x.k AND y.g = c.g[x.k + 1:c.k]),
        b AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
        h AS (SELECT lang, part, max(n) AS most FROM (SELECT lang, n, unnest([g[1:2], g[2:3]]) AS part FROM c WHERE k = 3) GROUP BY ALL),
        o AS (SELECT b.lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM b LEFT JOIN h ON h.lang = b.lang AND h.part = b.g
              WHERE most IS NULL OR 100 * most < 50 * a)
        SELECT lang, rank::INT AS rank, phrase, a, l, r, total AS n, score
        FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o) JOIN t USING (lang)
        WHERE rank <= 2000""",
    "op13_lexical": f"""
        WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_TERMS} AS w FROM documents),
        c AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
        i AS (SELECT row_number() OVER () AS k, item_id, unnest(list_distinct({_TERMS})) AS term FROM benchmark),
        p AS (SELECT k, doc_id, n, term, count(*)::BIGINT AS tf
              FROM (SELECT k, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d) SEMI JOIN i USING (term) GROUP BY ALL),
        t AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
              FROM p, c GROUP BY term),
        s AS (SELECT i.k AS item, item_id, p.k, doc_id,
                     sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
              FROM i JOIN t USING (term) JOIN p USING (term), c WHERE doc_id IS NOT NULL GROUP BY ALL)
        SELECT item_id, rank::INT AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
        WHERE rank <= 50""",
}
