"""SQL for the operators that SQL can express; written on its own, it shares no code with them."""

OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first_id FROM p GROUP BY d)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(p.d, ((i // 4) * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p JOIN f ON p.d = f.d
"""

OP5 = """
WITH u AS (
  SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r(rule, action, h, p) AS (VALUES ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
  ('www.example.com/en/', 'allow', 'www.example.com', '/en/'), ('net/es/', 'block', 'net', '/es/'), ('net/fr/', 'block', 'net', '/fr/')),
k(label) AS (VALUES ('spam-farm'), ('cheap-pills'), ('casino-win'), ('free-bets'), ('adult-x'), ('ads-track')),
judged AS (
  SELECT u.*,
    (SELECT max_by(rule, length(rule)) FROM r WHERE ('.' || host).ends_with('.' || h) AND path.starts_with(p)) AS rule,
    (SELECT min('||' || label || '.') FROM k WHERE contains('.' || host || '/', '.' || label || '.')) AS listed
  FROM u)
SELECT page_id, host, path, rule,
  CASE WHEN rule IS NOT NULL THEN (SELECT action FROM r WHERE r.rule = judged.rule)
    WHEN listed IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NULL THEN listed END AS pattern
FROM judged
"""


OP12 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP13 = r"""
WITH terms AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
size AS (SELECT count(*) AS docs, sum(len(t))::BIGINT AS words FROM terms WHERE len(t) > 0),
tf AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM terms) GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * (SELECT docs FROM size) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf GROUP BY term),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN w USING (term), size GROUP BY item_id, doc_id),
numbered AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM numbered WHERE rank <= 10
"""


def _merkle(levels: int = 6) -> str:
    """Level by level: ``levels`` for each source, as many over the sources; a tree of one node stays as it is."""
    field = "coalesce(strlen({0})::VARCHAR || ':' || {0}, '-')"
    leaf = lambda text: "sha256(concat(" + ", ".join(field.format(v) for v in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)) + "))"
    crc = (
        "list_reduce(list_prepend(4294967295, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)), "
        "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda a, s: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"
    )
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"d AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN xor({crc}, 4294967295) % 5 = 0 THEN {leaf(lowered)} ELSE {leaf('text')} END AS now FROM documents)",
        "n0 AS (SELECT source AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rank, leaf AS node, 0 AS below FROM d)",
        # The path of a leaf: its rank and its node's siblings so far, and its changed node.
        "p0 AS (SELECT doc_id, source AS tree, leaf, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rank, now, '' AS shown FROM d)",
    ]
    for number in range(2 * levels):
        nodes, paths = f"n{number}", f"p{number}"
        if number == levels:
            parts += [
                f"n{number}t AS (SELECT 'all' AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS rank, node, tree AS source FROM {nodes})",
                f"p{number}t AS (SELECT doc_id, 'all' AS tree, leaf, t.rank AS rank, now, shown, t.node AS subroot FROM {paths} p JOIN n{number}t t ON p.tree IS NOT DISTINCT FROM t.source)",
            ]
            nodes, paths = f"{nodes}t", f"{paths}t"
        extra = ", subroot" if number >= levels else ""
        parts += [
            f"c{number} AS (SELECT tree, count(*) AS size FROM {nodes} GROUP BY tree)",
            f"r{number} AS (SELECT tree, rank // 16 AS run, list(node ORDER BY rank) AS run_nodes, any_value(size) AS size "
            f"FROM {nodes} n JOIN c{number} c USING (tree) WHERE tree IS NOT NULL GROUP BY tree, rank // 16 "
            f"UNION ALL SELECT NULL, rank // 16, list(node ORDER BY rank), (SELECT size FROM c{number} WHERE tree IS NULL) "
            f"FROM {nodes} WHERE tree IS NULL GROUP BY rank // 16)",
            f"n{number + 1} AS (SELECT tree, run AS rank, CASE WHEN size = 1 THEN run_nodes[1] ELSE sha256(array_to_string(run_nodes, '')) END AS node FROM r{number})",
            f"p{number + 1} AS (SELECT doc_id, p.tree, leaf, run AS rank, CASE WHEN size = 1 THEN now ELSE "
            f"sha256(array_to_string(run_nodes[:rank % 16], '') || now || array_to_string(run_nodes[rank % 16 + 2:], '')) END AS now, "
            f"CASE WHEN size = 1 THEN shown ELSE shown || array_to_string(run_nodes[:rank % 16], '') || array_to_string(run_nodes[rank % 16 + 2:], '') END AS shown{extra} "
            f"FROM {paths} p JOIN r{number} r ON p.tree IS NOT DISTINCT FROM r.tree AND p.rank // 16 = r.run)",
        ]
    last = 2 * levels
    return (
        f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, (SELECT node FROM n{last}) AS root, sha256(shown) AS proof_sha256, "
        f"now AS folded_root, now = (SELECT node FROM n{last}) AS verified FROM p{last}"
    )


ORACLES = {"op3_warc": OP3, "op5_url_filters": OP5, "op11_bitmap_merkle": _merkle(), "op12_exact_dedup": OP12, "op13_ranked_search": OP13}
