"""SQL of the training-data operators over the given tables, one string per query."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text."""
    byte = "list_reduce(range(0, 8), lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END), xor(c, b))"
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT), lambda c, b: {byte}, 4294967295), 4294967295)"


def length_coded(columns: list[str]) -> str:
    return " || ".join(f"coalesce(strlen({c})::VARCHAR || ':' || {c}, '-')" for c in columns)


EXACT = f"""
    WITH d AS (SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS norm FROM documents),
    g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
    SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.norm) AS text_sha256
    FROM d JOIN g ON d.norm = g.norm"""

TURN = length_coded(["role", "text"])
TRIE = f"""
    WITH raw AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS r FROM raw),
    c AS (SELECT conv_id, n, {crc32('conv_id::VARCHAR')} % 9 AS h, conv_id - ((conv_id % 5) + 5) % 5 AS first FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id)),
    rebuilt AS (
      SELECT c.conv_id, t.r AS depth, role, text FROM c JOIN t ON t.conv_id = c.first WHERE t.r <= h
      UNION ALL SELECT c.conv_id, coalesce(least(c.h, b.n), 0) + t.r - c.h, role, text FROM c JOIN t ON t.conv_id = c.conv_id LEFT JOIN c b ON b.conv_id = c.first WHERE t.r > c.h),
    prefix AS (
      SELECT conv_id, depth, strlen(text) AS bytes, string_agg({TURN}, '' ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth) AS key FROM rebuilt
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
    ends AS (SELECT depth, key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS last FROM prefix) WHERE depth = last GROUP BY depth, key),
    node AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM prefix GROUP BY depth, key),
    parent AS (SELECT n.depth, n.key, p.key AS above, a.conv_id AS parent_conv_id FROM node n JOIN prefix p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 JOIN node a ON a.depth = p.depth AND a.key = p.key),
    child AS (SELECT depth - 1 AS depth, above AS key, count(*) AS n FROM parent GROUP BY 1, 2),
    full_ AS (SELECT node.*, coalesce(child.n, 0) AS n_children FROM node LEFT JOIN child ON child.depth = node.depth AND child.key = node.key),
    below AS (SELECT p.depth, p.key, sum((f.n_convs - 1) * f.bytes)::BIGINT AS saved_tokens, count(CASE WHEN f.n_children = 0 THEN 1 END) AS n_leaves FROM full_ f JOIN prefix p ON p.conv_id = f.conv_id AND p.depth <= f.depth GROUP BY p.depth, p.key)
    SELECT f.conv_id, f.depth, parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
    FROM full_ f JOIN below b ON b.depth = f.depth AND b.key = f.key LEFT JOIN parent p ON p.depth = f.depth AND p.key = f.key LEFT JOIN ends e ON e.depth = f.depth AND e.key = f.key"""

FIELDS = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR"]


def climbed(name: str, source: str, tree: str) -> str:
    """A recursive table of all nodes of trees of fanout 16: tree, level, idx, h, n (nodes of the tree on the level)."""
    return f"""{name}(tree, level, idx, h, n) AS (
      SELECT {tree}, 0, idx, h, count(*) OVER (PARTITION BY {tree}) FROM {source}
      UNION ALL SELECT tree, level + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 15) // 16 FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 16)"""


def sides(nodes: str) -> str:
    return ", ".join(f"coalesce(string_agg({nodes}.h, '' ORDER BY {nodes}.idx) FILTER ({nodes}.idx {op} own), '') AS {name}" for op, name in (("<", "left_"), (">", "right_")))


MERKLE = f"""
    WITH RECURSIVE d AS (
      SELECT doc_id, coalesce('=' || source, '-') AS tree, sha256({length_coded([*FIELDS, 'text'])}) AS h,
        CASE WHEN {crc32('doc_id::VARCHAR')} % 5 = 0 THEN sha256({length_coded([*FIELDS, LOWER.format('text')])}) ELSE sha256({length_coded([*FIELDS, 'text'])}) END AS presented FROM documents),
    r AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx FROM d),
    {climbed('lv', 'r', 'tree')},
    subs AS (SELECT tree, level AS top, h, row_number() OVER (ORDER BY tree) - 1 AS idx FROM lv WHERE n = 1),
    {climbed('up', 'subs', "'all'")},
    lower_ AS (SELECT tree, id, level AS step, {sides('l')} FROM (SELECT r.tree, r.idx AS id, l.level, l.idx, l.h, r.idx // CAST(pow(16, l.level) AS BIGINT) AS own FROM r JOIN lv l ON l.tree = r.tree AND l.n > 1 AND l.idx // 16 = r.idx // CAST(pow(16, l.level + 1) AS BIGINT)) l GROUP BY tree, id, level),
    upper_ AS (SELECT tree, step, {sides('u')} FROM (SELECT s.tree, s.top + u.level AS step, u.idx, u.h, s.idx // CAST(pow(16, u.level) AS BIGINT) AS own FROM subs s JOIN up u ON u.n > 1 AND u.idx // 16 = s.idx // CAST(pow(16, u.level + 1) AS BIGINT)) u GROUP BY tree, step),
    path AS (SELECT * FROM lower_ UNION ALL SELECT r.tree, r.idx, step, left_, right_ FROM r JOIN upper_ USING (tree)),
    proof AS (SELECT tree, id, string_agg(left_ || right_, '' ORDER BY step) AS all_ FROM path GROUP BY tree, id),
    folded(tree, id, step, h) AS (SELECT tree, idx, 0, presented FROM r UNION ALL SELECT f.tree, f.id, f.step + 1, sha256(p.left_ || f.h || p.right_) FROM folded f JOIN path p ON p.tree = f.tree AND p.id = f.id AND p.step = f.step),
    last_ AS (SELECT tree, id, arg_max(h, step) AS folded_root FROM folded GROUP BY tree, id)
    SELECT r.doc_id, r.h AS leaf, s.h AS subroot, u.h AS root, sha256(coalesce(all_, '')) AS proof_sha256, folded_root, folded_root = u.h AS verified
    FROM r JOIN subs s ON s.tree = r.tree JOIN (SELECT h FROM up WHERE n = 1) u ON true JOIN last_ l ON l.tree = r.tree AND l.id = r.idx LEFT JOIN proof p ON p.tree = r.tree AND p.id = r.idx"""

ORACLE_SQL = {"op1_exact_dedup": EXACT, "op11_prefix_trie": TRIE, "op13_merkle_manifest": MERKLE}
