"""One registered query per operator of this folder, over its whole table."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from flowtables.harness.registry import Query, table
from flowtables.llm import conversation_repair, decontamination, embedding_dedup, exact_dedup as exact, license_scan, near_dedup, packing, prefix_trie, substring_dedup, suffix_dedup, token_codes, toxicity, url_filter
from flowtables.session import scratch_path

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Folder of the public tokenizer files; by default where their Python package keeps them.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS")


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer file, the same on every machine of the cluster."""
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` it is tested against brute force in tests/llm."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_suffix_dedup", """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM p),
m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM w JOIN m USING (s) WHERE doc_id > least),
n AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE pos - 1 IS DISTINCT FROM before) AS n_spans
      FROM (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM c) GROUP BY doc_id),
b AS (SELECT doc_id, h, unnest(range(0, len(h) // 2)) AS pos FROM d),
k AS (SELECT doc_id, string_agg(substr(h, 2 * pos + 1, 2), '' ORDER BY pos) AS h FROM b ANTI JOIN c USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, cast(len(d.h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k.h, ''))) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
""")
def op1_suffix_dedup(spark, sf_dir):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return suffix_dedup.repeats(table(spark, sf_dir, "documents"), length=50).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )  # fmt: skip


# Fixed values: the rules of the contract as verdict, host and path.
URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))


@query("op2_url_filter")
def op2_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op3_substring_dedup", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
s AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 49), ' ') AS s FROM p),
m AS (SELECT s, min(doc_id) AS least FROM s GROUP BY s),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM s JOIN m USING (s) WHERE doc_id > least),
n AS (SELECT doc_id, count(*) AS n_removed FROM c GROUP BY doc_id),
b AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT doc_id, string_agg(w[i], ' ' ORDER BY i) AS kept FROM b ANTI JOIN c USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
""")
def op3_substring_dedup(spark, sf_dir):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return substring_dedup.repeated_windows(table(spark, sf_dir, "documents"), length=50).select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"),
    )  # fmt: skip


@query("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query("op5_exact_dedup", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM d JOIN g USING (text)
""")
def op5_exact_dedup(spark, sf_dir):
    snapshot, incoming = exact.halves(table(spark, sf_dir, "documents"))
    return exact.exact_dedup(snapshot, incoming).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op6_packing")
def op6_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer(), length=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op7_near_dedup")
def op7_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), threshold=0.8, size=5)


@query("op8_license_scan")
def op8_license_scan(spark, sf_dir):
    """One row per match, and one without a license for each document that has none."""
    found = license_scan.license_matches(table(spark, sf_dir, "documents"), license_scan.templates(), containment=0.8)
    return found.select("doc_id", F.explode_outer("matches").alias("m")).select("doc_id", "m.license", "m.start", "m.stop", "m.containment", "m.shared", "m.best")


@query("op9_decontamination", r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bl AS (SELECT item_id, w, least(10, len(w)) AS n FROM bw WHERE len(w) > 0),
bi AS (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bl),
items AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS phrase FROM bi),
di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM bl) WHERE len(w) >= n),
windows AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS phrase FROM di),
found AS (SELECT doc_id, i, n, item_id FROM windows JOIN items USING (n, phrase)),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS at FROM (SELECT DISTINCT doc_id, i, n FROM found)),
hits AS (SELECT doc_id, count(*) AS n_hit FROM covered GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op9_decontamination(spark, sf_dir):
    judged = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )  # fmt: skip


@query("op10_token_codes")
def op10_token_codes(spark, sf_dir):
    path = scratch_path(spark, "token-codes")
    token_codes.write_codes(table(spark, sf_dir, "documents"), path, tokenizer(), end_id=2)
    return token_codes.read_codes(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


#: CRC-32 of an ASCII string ``k`` of each row of ``keyed``, by its table; rows of ``crc`` are those of ``keyed`` with ``crc``.
_CRC = """
tab AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, i) AS v FROM (SELECT unnest(range(256)) AS i))),
crc AS (SELECT keyed.*, xor(list_reduce(list_transform(range(1, len(k) + 1), lambda p: cast(ascii(substr(k, p, 1)) AS BIGINT)),
        lambda a, b: xor(a // 256, t[1 + xor(a % 256, b)]), cast(4294967295 AS BIGINT)), 4294967295) AS crc FROM keyed, tab)
"""


def _edit(state: str, cost: str, letter: str) -> str:
    return f"{{'c': acc.{state}.c + {cost}, 'a': acc.{state}.a || '{letter}'}}"


def _least(*edits: str) -> str:
    return f"list_sort([{', '.join(edits)}])[1]"


#: One row of a conversation after the other: the cheapest (cost, audit) of each state. An insert is never
#: cheapest at these costs, since deleting the turn it completes, or both turns of a lone pair, costs less.
_FOLD = (
    "{'n': " + _edit("n", "2", "D")
    + ", 's': " + _least(_edit("s", "2", "D"), _edit("n", "(CASE WHEN r.i = 's' AND NOT r.gone THEN r.cut ELSE 1000000 END)", "K"))
    + ", 'u': " + _least(_edit("u", "2", "D"), *(e for q in "nsa" for e in (
        _edit(q, "(CASE WHEN r.i = 'u' AND NOT r.gone THEN r.cut ELSE 1000000 END)", "K"),
        _edit(q, "(CASE WHEN r.i <> 'u' AND NOT r.gone THEN 1 + r.cut ELSE 1000000 END)", "R"))))
    + ", 'a': " + _least(_edit("a", "2", "D"),
        _edit("u", "(CASE WHEN r.i = 'a' AND NOT r.gone THEN r.cut ELSE 1000000 END)", "K"),
        _edit("u", "(CASE WHEN r.i <> 'a' AND NOT r.gone THEN 1 + r.cut ELSE 1000000 END)", "R"))
    + "}"
)  # fmt: skip


@query("op11_conversation_repair", r"""
WITH keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(cast(conv_id AS VARCHAR), ' ') || ':' || coalesce(cast(turn AS VARCHAR), ' ') AS k FROM conversations),
""" + _CRC + r""",
hurt AS (SELECT conv_id, turn, CASE WHEN crc % 20 = 4 THEN 'user' ELSE role END AS role,
         CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN crc % 20 = 3 THEN [0, 1] ELSE [0] END) AS copy FROM crc WHERE crc % 20 <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p FROM hurt),
facts AS (SELECT *, substr(role, 1, 1) AS i, right(rtrim(text, E' 	

'), 1) AS tail,
          row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS again FROM placed),
judged AS (SELECT *, tail = '' AS is_blank, tail <> '' AND again AS is_again, tail <> '' AND NOT again AND tail NOT IN ('.', '!', '?') AS is_cut,
           lag(i) OVER (PARTITION BY conv_id ORDER BY p) || i AS pair FROM facts),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE is_blank) AS blank,
         count(*) FILTER (WHERE is_again) AS duplicate, count(*) FILTER (WHERE is_cut) AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal,
         list({'i': i, 'gone': is_blank OR is_again, 'cut': CASE WHEN is_cut THEN 5 ELSE 0 END} ORDER BY p) AS rows FROM judged GROUP BY conv_id),
ends AS (SELECT * EXCLUDE (rows), list_reduce(rows, lambda acc, r: """ + _FOLD + r""",
         {'n': {'c': 0, 'a': ''}, 's': {'c': 1000000, 'a': ''}, 'u': {'c': 1000000, 'a': ''}, 'a': {'c': 1000000, 'a': ''}}) AS e FROM sums),
best AS (SELECT * EXCLUDE (e), list_sort([e.n, e.a])[1] AS b FROM ends),
edits AS (SELECT judged.conv_id, p, role, text, b.a[p] AS edit FROM judged JOIN best ON judged.conv_id IS NOT DISTINCT FROM best.conv_id),
stay AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY p) AS q, count(*) FILTER (WHERE edit = 'K' AND substr(role, 1, 1) = 's') OVER (PARTITION BY conv_id) AS s
         FROM edits WHERE edit <> 'D'),
fixed AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (q - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, E'
' ORDER BY q) AS t FROM stay GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, cast(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.a, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN best ON o.conv_id IS NOT DISTINCT FROM best.conv_id LEFT JOIN fixed ON o.conv_id IS NOT DISTINCT FROM fixed.conv_id
""")
def op11_conversation_repair(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damage(turns), turns)


@query("op12_embedding_dedup", """
WITH RECURSIVE v AS (SELECT vec_id, cast(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT vec_id, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(e, lambda x: x * x)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.a = v.vec_id) AS n_links, min(reach.b) AS component_id, v.vec_id = min(reach.b) AS kept
FROM v JOIN reach ON reach.a = v.vec_id GROUP BY v.vec_id
""")
def op12_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_embeddings(table(spark, sf_dir, "embeddings"), threshold=0.9)


@query("op13_prefix_trie", """
WITH keyed AS (SELECT DISTINCT conv_id, cast(conv_id AS VARCHAR) AS k FROM conversations WHERE conv_id IS NOT NULL),
""" + _CRC + """,
named AS (SELECT conv_id, conv_id - conv_id % 100 AS base, crc % 6 AS h FROM crc),
own AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
        sha256(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[1:32] AS name FROM conversations WHERE conv_id IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name, len(text)) AS r FROM own),
built AS (SELECT n.conv_id, 0 AS part, t.r, t.name, len(t.text) AS tokens FROM named n JOIN ranked t ON t.conv_id = n.base AND t.r <= n.h
          UNION ALL SELECT n.conv_id, 1, t.r, t.name, len(t.text) FROM named n JOIN ranked t ON t.conv_id = n.conv_id AND t.r > n.h),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, r) AS d FROM built),
begun AS (SELECT conv_id, d, tokens, string_agg(name, '') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM turns
          UNION ALL SELECT conv_id, 0, 0, '' FROM named),
last AS (SELECT conv_id, max(d) AS d FROM begun GROUP BY conv_id),
ends AS (SELECT path, string_agg(cast(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM begun JOIN last USING (conv_id, d) GROUP BY path),
nodes AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(tokens) AS saved FROM begun GROUP BY path, d),
kids AS (SELECT left(path, len(path) - 32) AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
under AS (SELECT left(path, 32 * cast(up AS INTEGER)) AS path, sum(saved) AS saved, count(*) FILTER (WHERE n IS NULL) AS leaves
          FROM (SELECT nodes.path, saved, kids.n, unnest(range(0, d + 1)) AS up FROM nodes LEFT JOIN kids USING (path)) GROUP BY 1)
SELECT nodes.conv_id, nodes.d AS depth, parent.conv_id AS parent_conv_id, nodes.n_convs, coalesce(kids.n, 0) AS n_children,
       under.leaves AS n_leaves, cast(under.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes JOIN under USING (path) LEFT JOIN kids USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes parent ON nodes.d > 0 AND parent.path = left(nodes.path, len(nodes.path) - 32)
""")
def op13_prefix_trie(spark, sf_dir):
    seqs = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.with_shared_heads(seqs))
