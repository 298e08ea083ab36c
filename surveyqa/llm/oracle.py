"""DuckDB SQL of the queries that SQL can express over whole tables.

The others are tested against brute force in ``tests/llm``: a trained model (op4, op7), a tokenizer (op3,
op10), positions of all matches of a pattern (op6) and merged sketches (op9) are beyond SQL.
"""

COMPONENTS = """
    reach(a, b) AS (SELECT a, a FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    least AS (SELECT a, min(b) AS component FROM reach GROUP BY a)
"""

ORACLE_SQL = {
    "op1_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), shown AS (
            SELECT *, length(regexp_replace(text, '([\[<])(\\*)(/?SYS\]|/?INST\]|/?ROLE\]|SAYS\]|/?s>)', '\1\\\2\3', 'g')) AS shown,
                CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 END AS marks FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(shown + marks) AS BIGINT) AS formatted_chars
        FROM shown GROUP BY conv_id
    """,
    "op2_ngram_join": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), sets AS MATERIALIZED (
            SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')))
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words
        ), single AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
        links AS MATERIALIZED (
            SELECT x.doc_id AS a, y.doc_id AS b FROM single x JOIN single y ON x.g = y.g AND x.doc_id <> y.doc_id
            GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
        ), {COMPONENTS}
        SELECT doc_id, len(s) AS n_shingles, coalesce(component, doc_id) AS component_id FROM sets LEFT JOIN least ON a = doc_id
    """,
    "op5_embedding_join": f"""
        WITH RECURSIVE vectors AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        links AS MATERIALIZED (
            SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.label = y.label AND x.vec_id <> y.vec_id
            WHERE list_cosine_similarity(x.e, y.e) >= 0.93
        ), {COMPONENTS}, counts AS (SELECT a AS c, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept
        FROM vectors LEFT JOIN least ON least.a = vec_id LEFT JOIN counts ON c = vec_id
    """,
    "op8_mixing": r"""
        WITH sizes AS MATERIALIZED (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
        ), sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sizes GROUP BY source
        ), weighed AS (
            SELECT *, [3, 1, 2][(rank - 1) % 3 + 1] AS weight, 1.5 * sum(source_size) OVER () AS wanted FROM sources
        ), leveled AS (
            SELECT *, 2 * source_size / weight AS room, (wanted - 2 * coalesce(sum(source_size) OVER before, 0))
                / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
            FROM weighed WINDOW before AS (ORDER BY 2 * source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), targets AS MATERIALIZED (
            SELECT source, source_size, rank, CASE WHEN level > room THEN 2.0 * source_size
                ELSE weight * (SELECT level FROM leveled WHERE level <= room ORDER BY room, rank LIMIT 1) END AS target FROM leveled
        ), wanted AS (SELECT CAST(round(sum(target) / 64) AS BIGINT) AS seats FROM targets),
        quotas AS MATERIALIZED (
            SELECT rank, count(*) FILTER (nth <= seats) AS quota FROM (
                SELECT rank, seats, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, rank) AS nth
                FROM targets, wanted, range(0, (SELECT seats FROM wanted)) ks(k)
            ) GROUP BY rank
        ), dealt AS MATERIALIZED (
            SELECT doc_id, size, source_size, target, rank, quota AS seats,
                CAST('0x' || substr(md5('mix:' || doc_id), 1, 7) AS BIGINT) % greatest(1, CAST(ceil(source_size / 1048576) AS BIGINT)) AS shard,
                CAST('0x' || substr(md5('mix:order:' || doc_id), 1, 7) AS BIGINT) AS place
            FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source JOIN quotas USING (rank)
        ), shards AS (
            SELECT rank, shard, seats, CAST(sum(size) AS BIGINT) AS shard_size FROM dealt GROUP BY rank, shard, seats
        ), shares AS MATERIALIZED (
            SELECT rank, shard, shard_size, greatest(1, CAST(round(shard_size / 64) AS BIGINT)) AS blocks, count(*) FILTER (nth <= seats) AS quota,
                CAST('0x' || substr(md5('mix:offset:' || rank || ':' || shard), 1, 7) AS BIGINT) AS shift
            FROM (
                SELECT *, row_number() OVER (PARTITION BY rank ORDER BY shard_size / (2 * k + 1) DESC, shard) AS nth
                FROM (SELECT *, unnest(range(0, greatest(1, seats))) AS k FROM shards)
            ) GROUP BY rank, shard, shard_size
        ), placed AS (
            SELECT *, sum(size) OVER (PARTITION BY rank, shard ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS stop FROM dealt
        ), full_rows AS (
            SELECT doc_id, size, source_size, target, shard_size, blocks, least(quota, 2 * blocks) AS quota, shift,
                CAST(stop AS BIGINT) AS stop, CAST(stop AS BIGINT) - size AS start FROM placed JOIN shares USING (rank, shard)
        )
        SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE CAST(list_sum(list_transform(
            range(((start + 1) * blocks - 1) // shard_size, (stop * blocks - 1) // shard_size + 1),
            lambda b: (least(stop, (b + 1) * shard_size // blocks) - greatest(start, b * shard_size // blocks))
                * (quota // blocks + CASE WHEN (b * 2147483647 + shift) % blocks < quota % blocks THEN 1 ELSE 0 END))) AS BIGINT) END AS taken
        FROM full_rows
    """,
    "op11_importance_resampling": r"""
        WITH steps AS (
            SELECT list_transform(range(256), lambda k: list_reduce(list_concat([k], [0, 0, 0, 0, 0, 0, 0, 0]),
                lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
        ), texts AS (
            SELECT doc_id, true AS own, text FROM documents UNION ALL SELECT item_id, false, text FROM benchmark
        ), cut AS MATERIALIZED (
            SELECT doc_id, own, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
        ), occurring AS MATERIALIZED (SELECT doc_id, own, unnest(w) AS w FROM cut),
        hashed AS MATERIALIZED (
            SELECT w, xor(list_reduce(list_concat([4294967295], list_transform(range(CAST(octet_length(encode(w)) AS BIGINT)),
                lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS BIGINT))),
                lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
            FROM (SELECT DISTINCT w FROM occurring), steps
        ), counts AS (
            SELECT bucket, CAST(count(*) FILTER (own) AS DOUBLE) AS s, CAST(count(*) FILTER (NOT own) AS DOUBLE) AS t
            FROM occurring JOIN hashed USING (w) GROUP BY bucket
        ), gains AS MATERIALIZED (
            SELECT bucket, CAST(floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000)) / ((s + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain
            FROM counts
        ), weights AS (
            SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM occurring JOIN hashed USING (w) JOIN gains USING (bucket) WHERE own GROUP BY doc_id
        ), scored AS (
            SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
                (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
            FROM cut LEFT JOIN weights USING (doc_id) WHERE own
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
                10 * count(*) FILTER (n_features >= 20) OVER () // 100 AS chosen FROM scored
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= chosen THEN place END AS rank FROM placed
    """,
}
