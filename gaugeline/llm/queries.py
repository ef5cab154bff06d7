"""Registered queries of the training-data operators, each over its whole table."""

from pyspark.sql import functions as F

from gaugeline.llm.registry import ORACLES, QUERIES, query
from gaugeline.sources.tables import table

__all__ = ["ORACLES", "QUERIES"]


@query("""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
r AS (WITH RECURSIVE reach(x, y) AS (SELECT x, y FROM l UNION SELECT reach.x, l.y FROM reach JOIN l ON l.x = reach.y)
    SELECT x, min(y) AS least FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(r.least, doc_id)) AS component_id,
    doc_id = least(doc_id, coalesce(r.least, doc_id)) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.x = doc_id
""")
def op8_minhash_near_dedup(spark, folder):
    """MinHash near-duplicates of the documents, at a similarity of 0.85 of 5-word shingles."""
    from gaugeline.llm.near_duplicates import link_components

    return link_components(table(spark, folder, "documents"), 85)


@query("""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS x FROM documents),
w AS (SELECT doc_id, unnest(range(0, octet_length(x) - 199)) AS p,
    unnest(list_transform(range(0, octet_length(x) - 199), lambda i: md5(x[i + 1:i + 200]))) AS k FROM d),
t AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
c AS (SELECT doc_id, p, p > coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200, -1) AS fresh FROM w WHERE k IN (SELECT k FROM t)),
i AS (SELECT doc_id, p, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM c),
s AS (SELECT doc_id, span, min(p) AS a, max(p) + 200 AS b FROM i GROUP BY ALL),
g AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM s),
k AS (SELECT g.doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
    string_agg(CASE WHEN a > before THEN hex(x[before + 1:a]) ELSE '' END, '' ORDER BY a) AS kept FROM g JOIN d USING (doc_id) GROUP BY g.doc_id)
SELECT doc_id, octet_length(x)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept, '') || CASE WHEN octet_length(x) > coalesce(last, 0) THEN hex(x[coalesce(last, 0) + 1:octet_length(x)]) ELSE '' END)) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
""")
def op4_suffix_array_dedup(spark, folder):
    """Repeated 200-byte strings removed from the documents."""
    from gaugeline.llm.repeated_spans import remove_repeats

    return remove_repeats(table(spark, folder, "documents"), 200).drop("kept")


@query("""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
i AS (SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[p:p + 9], ' ') AS g FROM b, unnest(range(1, greatest(len(ws) - 8, 2))) AS u(p) WHERE len(ws) > 0),
s AS (SELECT DISTINCT k FROM i),
t AS (SELECT doc_id, p, k, array_to_string(ws[p:p + k - 1], ' ') AS g FROM d, s, unnest(range(1, len(ws) - k + 2)) AS u(p)),
h AS (SELECT doc_id, p, t.k, item_id FROM t JOIN i ON i.g = t.g AND i.k = t.k),
c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM h, unnest(range(p, p + k)) AS u(q) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM h) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)
""")
def op9_decontamination(spark, folder):
    """Words of the documents inside windows of 10 words of benchmark items."""
    from gaugeline.llm.decontamination import find_contamination

    found = find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), 10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query()
def op10_secret_scan(spark, folder):
    """Secrets in the documents."""
    from gaugeline.llm.secrets import scan_secrets

    return scan_secrets(table(spark, folder, "documents")).drop("masked")


@query()
def op5_quartile_fingerprints(spark, folder):
    """Quartile bucket digests of the documents, of their edited texts, and likenesses."""
    from gaugeline.llm.fingerprints import fingerprint_documents

    return fingerprint_documents(table(spark, folder, "documents"))


@query("""
WITH u AS (SELECT page_id, url, instr(url, '://') AS k, substr(url, instr(url, '://') + 3) AS rest FROM pages),
p AS (SELECT page_id, CASE WHEN k > 0 THEN translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN k > 0 THEN regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') ELSE '' END AS path FROM u),
r(h, q, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m AS (SELECT p.*, h, q, v FROM p LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q)),
b AS (SELECT page_id, host, path, max({'n': length(h) + length(q), 'rule': h || q, 'v': v}) FILTER (h IS NOT NULL) AS best FROM m GROUP BY ALL)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.v, 'allow') AS verdict FROM b
""")
def op2_url_filters(spark, folder):
    """Verdict of the url rules for every page."""
    from gaugeline.llm.url_filters import RULES, judge_urls, rule_table

    return judge_urls(table(spark, folder, "pages").select("page_id", "url"), rule_table(spark, RULES))


@query()
def op3_quality_classifier(spark, folder):
    """Quality of every document, learned from the labels outside the held-out fold."""
    from gaugeline.llm.quality import classify

    return classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op1_pfair_mix(spark, folder):
    """All documents in a mix of their sources, weighted by the square root of their characters."""
    from gaugeline.llm.mixing import mix

    return mix(table(spark, folder, "documents"))


@query("""
WITH h AS (SELECT page_id, coalesce(html, '') AS html, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
    || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html'
    || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) AS head FROM pages),
r AS (SELECT page_id, head || html || chr(13) || chr(10) || chr(13) || chr(10) AS record FROM h),
s AS (SELECT page_id, record, strlen(record) AS size, md5(record) AS digest, (SELECT 1 + sum(strlen(record))::BIGINT // 4194304 FROM r) AS files FROM r),
f AS (SELECT *, ('0x' || substr(digest, 1, 8))::BIGINT % files AS file FROM s),
o AS (SELECT *, row_number() OVER w - 1 AS seq, sum(size) OVER w AS stop, ('0x' || substr(md5('rot:' || page_id), 1, 8))::BIGINT % 97 AS rot
    FROM f WINDOW w AS (PARTITION BY file ORDER BY page_id, digest))
SELECT file, seq, page_id, (stop - size)::BIGINT AS start, stop::BIGINT AS stop, sha256(record) AS hash,
    CASE rot WHEN 0 THEN sha256(record[:-5]) WHEN 1 THEN sha256('X' || record[2:]) END AS other_hash, CASE rot WHEN 2 THEN 'missing' ELSE 'changed' END AS damage
FROM o WHERE rot < 3
""")
def op6_merkle_fixity(spark, folder):
    """Damaged records of a replica of the pages' WARC files; the replica is derived with every 32nd record or so cut, overwritten or lost."""
    from gaugeline.llm.fixity import audit, to_warc
    from gaugeline.sources.tables import stored

    records = stored(to_warc(table(spark, folder, "pages")), "warc")
    rot = F.conv(F.substring(F.md5(F.concat(F.lit("rot:"), F.col("page_id").cast("string"))), 1, 8), 16, 10).cast("long") % 97
    cut = F.expr("substring(record, 1, octet_length(record) - 4)")
    over = F.concat(F.lit(b"X"), F.expr("substring(record, 2)"))
    replica = records.withColumn("rot", F.coalesce(rot, F.lit(96))).where("rot <> 2").withColumn(
        "record", F.when(F.col("rot") == 0, cut).when(F.col("rot") == 1, over).otherwise(F.col("record")))
    found = audit(records, replica)
    return found.join(records.select("file", "seq", "page_id"), ["file", "seq"], "left").select(
        "file", "seq", "page_id", "start", "stop", "hash", "other_hash", "damage")


@query()
def op7_katz_backoff(spark, folder):
    """Base and Katz backoff log probabilities of the documents, learned from the training fold; every word of it is in the vocabulary."""
    from gaugeline.llm.katz import score_documents

    return score_documents(table(spark, folder, "documents"), min_count=1)


@query()
def op11_best_fit_packing(spark, folder):
    """All documents as tokens, packed into sequences of 2048."""
    import public_tokenizers

    from gaugeline.llm.packing import pack_documents

    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


@query("""
WITH RECURSIVE d AS (SELECT *, xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 2 = 0 AS hit FROM documents),
v AS (SELECT doc_id, source, replace(text, chr(10), '') AS cut, hit, text,
    concat_ws('', CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END, CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END,
        CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END, CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END) AS head FROM d),
f AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN hit THEN sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS other FROM v),
g AS (SELECT doc_id, leaf, other, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n FROM f),
t(s, lvl, i, h, n) AS (SELECT s, 0, i, leaf, n FROM g
    UNION ALL SELECT s, lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 2) // 3 FROM t WHERE n > 1 GROUP BY s, lvl, i // 3),
r AS (SELECT s, h, count(*) OVER () AS n FROM t WHERE n = 1),
u(lvl, i, h, n) AS (SELECT 0, s, h, n FROM r UNION ALL SELECT lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 2) // 3 FROM u WHERE n > 1 GROUP BY lvl, i // 3),
e AS (SELECT s, lvl, i, coalesce(string_agg(h, '' ORDER BY i) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
    coalesce(string_agg(h, '' ORDER BY i) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM t WHERE n > 1 WINDOW w AS (PARTITION BY s, lvl, i // 3 ORDER BY i)),
k AS (SELECT lvl, i, coalesce(string_agg(h, '' ORDER BY i) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
    coalesce(string_agg(h, '' ORDER BY i) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM u WHERE n > 1 WINDOW w AS (PARTITION BY lvl, i // 3 ORDER BY i)),
p(doc_id, s, lvl, i, inside, h, proof) AS (SELECT doc_id, s, 0, i, n > 1, other, '' FROM g
    UNION ALL (
        SELECT p.doc_id, p.s, p.lvl + 1, p.i // 3, (SELECT max(n) FROM t WHERE t.s = p.s AND t.lvl = p.lvl + 1) > 1, sha256(e.a || p.h || e.b), p.proof || e.a || e.b
            FROM p JOIN e ON e.s = p.s AND e.lvl = p.lvl AND e.i = p.i WHERE p.inside)),
q(doc_id, s, lvl, i, h, proof) AS (SELECT doc_id, s, 0, s, h, proof FROM p WHERE NOT inside
    UNION ALL SELECT q.doc_id, q.s, q.lvl + 1, q.i // 3, sha256(k.a || q.h || k.b), q.proof || k.a || k.b FROM q JOIN k ON k.lvl = q.lvl AND k.i = q.i)
SELECT g.doc_id, g.leaf, r.h AS subroot, z.h AS root, sha256(q.proof) AS proof_sha256, q.h AS folded_root, q.h = z.h AS verified
FROM g JOIN r USING (s) JOIN q USING (doc_id) CROSS JOIN (SELECT h FROM u WHERE n = 1) z WHERE q.lvl = (SELECT max(lvl) FROM u)
""")
def op12_merkle_manifest(spark, folder):
    """Leaves, roots and proofs of the documents by source, and the roots that a replica without line ends in half of them folds to."""
    from gaugeline.llm.manifest import manifest, without_line_ends

    docs = table(spark, folder, "documents")
    leaf, other = without_line_ends(docs)
    out = manifest(docs.select("doc_id", "source", leaf.alias("leaf"), other.alias("other")))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query("""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
c AS (SELECT count(*) FILTER (len(ws) > 0) AS nn, sum(len(ws))::BIGINT AS ll FROM d),
b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark),
p AS (SELECT doc_id, w, any_value(n) AS n, count(*) AS tf FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS w FROM d) GROUP BY doc_id, w),
x AS (SELECT w, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM p, c GROUP BY w, nn),
s AS (SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll))))::BIGINT AS score
    FROM b JOIN p USING (w) JOIN x USING (w) CROSS JOIN c GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 50
""")
def op13_ranked_search(spark, folder):
    """The 50 best documents of every benchmark item."""
    from gaugeline.llm.search import rank_documents

    return rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
