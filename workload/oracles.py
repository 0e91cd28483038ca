"""The same results in SQL, as CTE chains over the given tables."""

from __future__ import annotations

import hashlib

from chunkloom.functions.paths import DEFAULT_KEY

_PATH = "concat('repo/', source, '/', lang, '/doc_', doc_id, '.py')"

CODE_FILES = f"""
code_files AS (
  SELECT doc_id, {_PATH} AS path,
    CASE WHEN doc_id % 50 = 7 THEN '  ' || chr(10) ELSE concat(
      array_to_string(list_transform(string_split(text, chr(10)), lambda l, i:
        CASE WHEN (i - 1) % 5 = 0 THEN concat('def fn_', i - 1, '(a, b):', chr(10), '    ', l)
             WHEN (i - 1) % 5 = 3 THEN concat('class K', i - 1, ':', chr(10), '    # ', l)
             ELSE concat('    ', l) END), chr(10)),
      CASE WHEN doc_id % 10 = 0 THEN chr(10) || '# Erro' || chr(10)
           WHEN doc_id % 2 = 0 THEN chr(10) ELSE '' END) END AS content
  FROM documents)"""

_NESTED_FILES = f"""
files AS (SELECT {_PATH} AS path,
    array_to_string(list_transform(string_split(text, chr(10)), lambda l, i:
      CASE WHEN (i - 1) % 5 = 0 THEN concat('def fn_', i - 1, '(a, b):', chr(10), '    ', l)
           WHEN (i - 1) % 5 = 2 THEN concat('    def inner_', i - 1, '(self):', chr(10), '        ', l)
           WHEN (i - 1) % 5 = 3 THEN concat('# About K', i - 1, chr(10), '@wrap', chr(10),
             'class K', i - 1, ':', chr(10), '    # ', l)
           ELSE concat('    ', l) END), chr(10)) AS content
  FROM documents)"""

ALL_FILES = "files AS (SELECT path, content FROM code_files)"
KNOWN_FILES = "files AS (SELECT path, content FROM code_files WHERE doc_id % 3 = 0)"

# Fixed value: a definition header at the start of a stripped line.
_HEADER = (
    r"(class\s+[\p{L}\p{N}_]+\s*\(?[^)]*\)?:|def\s+[\p{L}\p{N}_]+\s*\(?[^)]*\)?:)"
)


def _lines(p: str = "", files: str = "files") -> str:
    """Lines of nonblank files, with their terminators."""
    return rf"""
{p}split_text AS (SELECT path, string_split(content, chr(10)) AS a FROM {files}
  WHERE regexp_matches(content, '\S')),
{p}pieces AS (SELECT path, unnest(range(len(a))) AS ln, unnest(a) AS x, len(a) AS n
  FROM {p}split_text),
{p}lines AS (SELECT path, ln, x, CASE WHEN ln < n - 1 THEN x || chr(10) ELSE x END AS line
  FROM {p}pieces WHERE NOT (ln = n - 1 AND x = ''))"""


def _chunks(p: str = "", files: str = "files") -> str:
    """Line-mode chunks with their true first and last lines."""
    return rf"""{_lines(p, files)},
{p}marked AS (SELECT *, (ln > 0 AND regexp_matches(x, '^\s*{_HEADER}'))::int AS opens FROM {p}lines),
{p}placed AS (SELECT *, sum(opens) OVER (PARTITION BY path ORDER BY ln) AS ci FROM {p}marked),
{p}chunks AS (SELECT path, ci::int AS chunk_index, string_agg(line, '' ORDER BY ln) AS chunk,
    min(ln) + 1 AS true_start, max(ln) + 1 AS true_end
  FROM {p}placed GROUP BY path, ci),
{p}hashed AS (SELECT *, sha256(chunk) AS chunk_hash FROM {p}chunks)"""


def _roots(p: str = "") -> str:
    """Roots per path; needs ``WITH RECURSIVE``."""
    return f"""
{p}leaves AS (SELECT path, chunk_index::bigint AS pos, chunk_hash AS h,
    count(*) OVER (PARTITION BY path) AS n FROM {p}hashed),
{p}tree AS (SELECT path, pos, h, n FROM {p}leaves
  UNION ALL
  SELECT path, pos // 2, sha256(string_agg(h, '' ORDER BY pos)
      || CASE WHEN count(*) = 1 THEN max(h) ELSE '' END), (max(n) + 1) // 2
  FROM {p}tree WHERE n > 1 GROUP BY path, pos // 2),
{p}roots AS (SELECT t.path, t.h AS root_hash, c.n_chunks
  FROM {p}tree t JOIN (SELECT path, count(*)::int AS n_chunks FROM {p}leaves GROUP BY path) c
    USING (path) WHERE t.n = 1)"""


_KEY_BYTES = list(hashlib.sha256(DEFAULT_KEY.encode()).digest())


def _pseudonym(path: str) -> str:
    segment = f"""translate(base64(unhex(array_to_string(list_transform(
      range(len(hex(encode(s))) // 2), lambda i: printf('%02x', xor(
        ('0x' || substr(hex(encode(s)), (i * 2 + 1)::int, 2))::int,
        {_KEY_BYTES}[(i % 32 + 1)::int]::int))), ''))), '+/', '-_')"""
    return f"""array_to_string(list_transform(string_split({path}, '/'),
      lambda s: CASE WHEN s = '' THEN '' ELSE {segment} END), '/')"""


_PSEUDONYMS = f"paths AS (SELECT path, {_pseudonym('path')} AS obf FROM files)"

_SPANS = """
spans AS (SELECT *, length(chunk) - length(replace(chunk, chr(10), '')) AS nl FROM hashed),
spanned AS (SELECT *, (1 + coalesce(sum(nl + 1) OVER (PARTITION BY path ORDER BY chunk_index
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::int AS start_line FROM spans),
described AS (SELECT s.*, s.start_line + nl AS end_line, p.obf,
    replace(substr(chunk, 1, 50), chr(10), ' ') || '...' AS content_preview,
    contains(lower(chunk), 'erro') AS fails,
    substr(sha256(concat(chunk, obf, start_line, start_line + nl)), 1, 16) AS sent_id,
    substr(sha256(concat(chunk, obf, chunk_index)), 1, 16) AS cached_id
  FROM spanned s JOIN paths p USING (path))"""

DESCRIBED = f"{CODE_FILES}, {ALL_FILES}, {_chunks()}, {_PSEUDONYMS}, {_SPANS}"

KNOWN = (
    f"known_files AS (SELECT path, content FROM code_files WHERE doc_id % 3 = 0), "
    f"{_chunks('k_', 'known_files')}, {_roots('k_')}, "
    "known AS (SELECT DISTINCT root_hash FROM k_roots)"
)

_INDEX_COLUMNS = """
  d.path AS original_file_path, d.obf AS obfuscated_file_path, d.chunk_index::int AS chunk_index,
  d.content_preview,
  CASE WHEN k.root_hash IS NOT NULL THEN d.cached_id WHEN NOT d.fails THEN d.sent_id END
    AS embedding_id,
  CASE WHEN k.root_hash IS NULL THEN concat(d.start_line, '-', d.end_line) END AS lines,
  CASE WHEN k.root_hash IS NOT NULL THEN 'cached' WHEN d.fails THEN 'failed' ELSE 'processed' END
    AS status,
  d.start_line::int AS start_line, d.end_line::int AS end_line,
  d.true_start::int AS true_start, d.true_end::int AS true_end, d.chunk_hash, r.root_hash"""

INDEX = f"""{DESCRIBED}, {_roots()}, {KNOWN},
idx AS (SELECT {_INDEX_COLUMNS}
  FROM described d JOIN roots r USING (path) LEFT JOIN known k ON k.root_hash = r.root_hash)"""

# Both states as one set of files; the first two characters of a path tell which.
_TWO_STATES = f"""{CODE_FILES},
files AS (SELECT '0|' || path AS path,
    content || CASE WHEN doc_id % 3 = 1 THEN chr(10) || '# v0' ELSE '' END AS content
    FROM code_files WHERE doc_id % 11 <> 0
  UNION ALL SELECT '1|' || path, content FROM code_files WHERE doc_id % 13 <> 0),
{_chunks()}, paths AS (SELECT path, {_pseudonym('substr(path, 3)')} AS obf FROM files),
{_SPANS}, {_roots()},
waves AS (SELECT * FROM (VALUES (0, '0'), (1, '1'), (2, '1')) v (batch_id, state)),
failed AS (SELECT DISTINCT path FROM described WHERE fails),
known AS (SELECT DISTINCT w.batch_id, r.root_hash FROM roots r JOIN waves w
    ON substr(r.path, 1, 1)::int < w.batch_id WHERE r.path NOT IN (SELECT path FROM failed)),
idx AS (SELECT w.batch_id, {_INDEX_COLUMNS.replace('d.path AS', 'substr(d.path, 3) AS')}
  FROM described d JOIN roots r USING (path) JOIN waves w ON w.state = substr(d.path, 1, 1)
  LEFT JOIN known k ON k.root_hash = r.root_hash AND k.batch_id = w.batch_id)"""

_CLASS_CHUNKS = """
c_hashed AS (SELECT path, row_number() OVER (PARTITION BY path ORDER BY chunk_index) - 1
    AS chunk_index, chunk_hash FROM hashed WHERE contains(chunk, 'class '))"""

SNAPSHOTS = f"""{CODE_FILES},
old_files AS (SELECT path, content || CASE WHEN doc_id % 3 = 1 THEN chr(10) || '# v0' ELSE '' END
    AS content FROM code_files WHERE doc_id % 11 <> 0),
new_files AS (SELECT path, content FROM code_files WHERE doc_id % 13 <> 0),
{_chunks('o_', 'old_files')}, {_roots('o_')}, {_chunks('n_', 'new_files')}, {_roots('n_')},
changes AS (SELECT coalesce(o.path, n.path) AS path,
    CASE WHEN o.path IS NULL THEN 'added' WHEN n.path IS NULL THEN 'removed'
         WHEN o.root_hash = n.root_hash AND o.n_chunks = n.n_chunks THEN 'unchanged'
         ELSE 'changed' END AS change,
    o.root_hash AS old_root_hash, n.root_hash AS new_root_hash
  FROM o_roots o FULL OUTER JOIN n_roots n ON o.path = n.path)"""

_TOP_LEVEL = rf"""{_lines()},
kinds AS (SELECT *, regexp_matches(x, '^[@#]') AS attached, regexp_matches(x, '^{_HEADER}') AS is_def,
    regexp_matches(x, '^\s*[^\s@#]') AS is_code FROM lines),
owned AS (SELECT *, first_value(CASE WHEN NOT attached THEN is_def END IGNORE NULLS) OVER (
      PARTITION BY path ORDER BY ln ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS def_next,
    coalesce(lag(attached) OVER (PARTITION BY path ORDER BY ln), false) AS after_attached,
    coalesce(max(is_code::int) OVER (PARTITION BY path ORDER BY ln
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS after_code FROM kinds),
opened AS (SELECT *, (ln > 0 AND after_code AND coalesce(def_next, false)
    AND (attached OR is_def) AND NOT after_attached)::int AS opens FROM owned),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY path ORDER BY ln) AS ci FROM opened),
top_chunks AS (SELECT path, ci::int AS chunk_index, string_agg(line, '' ORDER BY ln) AS chunk
  FROM numbered GROUP BY path, ci)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{select}"


_FILES = f"{CODE_FILES}, {ALL_FILES}"

_CORPUS = """
ordered AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, sha256(text) AS h,
    count(*) OVER () AS n FROM documents),
tree AS (SELECT pos, h, n FROM ordered
  UNION ALL
  SELECT pos // 2, sha256(string_agg(h, '' ORDER BY pos)
      || CASE WHEN count(*) = 1 THEN max(h) ELSE '' END), (max(n) + 1) // 2
  FROM tree WHERE n > 1 GROUP BY pos // 2)"""

_TWO_CORPORA = """
states AS (SELECT 'new' AS state, doc_id, text FROM documents
  UNION ALL SELECT 'old', doc_id, text || CASE WHEN doc_id % 97 = 5 THEN chr(10) || '# v0' ELSE '' END
  FROM documents WHERE doc_id <= (SELECT max(doc_id) * 9 / 10 FROM documents)),
ordered AS (SELECT state, row_number() OVER (PARTITION BY state ORDER BY doc_id) - 1 AS pos,
    sha256(text) AS h, count(*) OVER (PARTITION BY state) AS n FROM states),
tree AS (SELECT state, pos, h, n FROM ordered
  UNION ALL
  SELECT state, pos // 2, sha256(string_agg(h, '' ORDER BY pos)
      || CASE WHEN count(*) = 1 THEN max(h) ELSE '' END), (max(n) + 1) // 2
  FROM tree WHERE n > 1 GROUP BY state, pos // 2)"""

_CORPUS_NODES = """
ordered AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, sha256(text) AS h,
    count(*) OVER () AS n FROM documents),
nodes AS (SELECT 0 AS level, pos, h, n, NULL::varchar AS l, NULL::varchar AS r FROM ordered
  UNION ALL
  SELECT max(level) + 1, pos // 2,
    sha256(string_agg(h, '' ORDER BY pos) || CASE WHEN count(*) = 1 THEN max(h) ELSE '' END),
    (max(n) + 1) // 2, arg_min(h, pos), arg_max(h, pos)
  FROM nodes WHERE n > 1 GROUP BY pos // 2)"""

_CONVERSATIONS = """
ordered AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos,
    sha256(text) AS h, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
tree AS (SELECT conv_id, pos, h, n FROM ordered
  UNION ALL
  SELECT conv_id, pos // 2, sha256(string_agg(h, '' ORDER BY pos)
      || CASE WHEN count(*) = 1 THEN max(h) ELSE '' END), (max(n) + 1) // 2
  FROM tree WHERE n > 1 GROUP BY conv_id, pos // 2)"""

_NODES = """
sizes AS (SELECT path, pos, h, n, 0 AS level FROM leaves),
nodes AS (SELECT path, level, pos, h, n, NULL::varchar AS l, NULL::varchar AS r FROM sizes
  UNION ALL
  SELECT path, max(level) + 1, pos // 2,
    sha256(string_agg(h, '' ORDER BY pos) || CASE WHEN count(*) = 1 THEN max(h) ELSE '' END),
    (max(n) + 1) // 2, arg_min(h, pos), arg_max(h, pos)
  FROM nodes WHERE n > 1 GROUP BY path, pos // 2)"""

_CACHE = "cache AS (SELECT chunk_hash, min(cached_id) AS embedding FROM described " \
    "WHERE path IN (SELECT path FROM code_files WHERE doc_id % 3 = 0) GROUP BY chunk_hash)"

_RUNS = """
run_rows AS (SELECT path, 1::bigint AS run_id, root_hash, n_chunks FROM o_roots
  UNION ALL SELECT path, 2::bigint, root_hash, n_chunks FROM n_roots)"""


def oracle_sql() -> dict[str, str]:
    found = _oracle_sql()
    return found | {"stored_cache": found["reuse_embeddings"]}


def _oracle_sql() -> dict[str, str]:
    chunks = f"{_FILES}, {_chunks()}"
    roots = f"{chunks}, {_roots()}"
    return {
        "matching_files": """
            SELECT path, n_chars FROM (SELECT concat(source,
                CASE doc_id % 4 WHEN 0 THEN '/.git/' WHEN 1 THEN '/pkg.git/' ELSE '/' END,
                'doc_', doc_id, CASE doc_id % 3 WHEN 0 THEN '.txt' WHEN 1 THEN '.PY' ELSE '.py' END)
                AS path, n_chars FROM documents)
            WHERE suffix(path, '.py') AND NOT contains(path, '/.git/')""",
        "nonblank_files": _with(
            _FILES, r"SELECT path, content FROM files WHERE regexp_matches(content, '\S')"
        ),
        "boundary_lines": _with(
            f"{_FILES}, {_lines()}",
            rf"""SELECT path, ln::int AS line_index, line,
              regexp_matches(x, '^\s*{_HEADER}') AS is_boundary FROM lines""",
        ),
        "chunks_line": _with(chunks, "SELECT path, chunk_index, chunk FROM chunks"),
        "chunks_custom_pattern": _with(
            f"{CODE_FILES}, {ALL_FILES}, " + _chunks().replace(_HEADER, r"class\s"),
            "SELECT path, chunk_index, chunk FROM chunks",
        ),
        "chunks_top_level": _with(
            f"{_FILES}, {_TOP_LEVEL}", "SELECT path, chunk_index, chunk FROM top_chunks"
        ),
        "chunks_nested_top_level": _with(
            f"{_NESTED_FILES}, {_TOP_LEVEL}", "SELECT path, chunk_index, chunk FROM top_chunks"
        ),
        "chunks_nested_line": _with(
            f"{_NESTED_FILES}, {_chunks()}", "SELECT path, chunk_index, chunk FROM chunks"
        ),
        "chunk_counts": _with(
            chunks, "SELECT path, count(*)::int AS n_chunks FROM chunks GROUP BY path"
        ),
        "line_spans": _with(
            DESCRIBED,
            """SELECT path, chunk_index, start_line::int AS start_line, end_line::int AS end_line,
              true_start::int AS true_start, true_end::int AS true_end FROM described""",
        ),
        "pieced_chunks": _with(
            DESCRIBED,
            """SELECT path, chunk_index::bigint AS chunk_index, chunk, start_line::bigint AS start_line,
              end_line::bigint AS end_line, true_start::bigint AS true_start,
              true_end::bigint AS true_end FROM described""",
        ),
        "leaf_hashes": _with(chunks, "SELECT path, chunk_index, chunk_hash FROM hashed"),
        "merkle_roots": _with(roots, "SELECT path, root_hash, n_chunks FROM roots"),
        "merkle_nodes": _with(
            f"{roots}, {_NODES}",
            """SELECT path, level::int AS level, pos::bigint AS pos, h AS hash, l AS left_hash,
              r AS right_hash FROM nodes""",
        ),
        "conversation_roots": _with(
            _CONVERSATIONS,
            """SELECT conv_id, h AS root_hash, n_leaves FROM tree JOIN (SELECT conv_id,
              count(*) AS n_leaves FROM conversations GROUP BY conv_id) USING (conv_id)
              WHERE n = 1""",
        ),
        "corpus_nodes": _with(
            _CORPUS_NODES,
            """SELECT level::int AS level, pos::bigint AS pos, h AS hash, l AS left_hash,
              r AS right_hash FROM nodes""",
        ),
        "updated_corpus_root": _with(
            _TWO_CORPORA,
            """SELECT state, h AS root_hash, (SELECT count(*) FROM states s WHERE s.state = t.state)
              AS n_leaves FROM tree t WHERE n = 1""",
        ),
        "corpus_root": _with(
            _CORPUS,
            """SELECT h AS root_hash, (SELECT count(*) FROM documents)::bigint AS n_leaves
              FROM tree WHERE n = 1""",
        ),
        "obfuscated": _with(
            f"{_FILES}, {_PSEUDONYMS}", "SELECT path, obf AS pseudonym FROM paths"
        ),
        "deobfuscated": _with(
            f"{_FILES}, {_PSEUDONYMS}", "SELECT obf AS pseudonym, path FROM paths"
        ),
        "embedding_ids": _with(
            DESCRIBED,
            """SELECT path, chunk_index, CASE WHEN NOT fails THEN sent_id END AS embedding_id,
              concat(start_line, '-', end_line) AS lines FROM described""",
        ),
        "cached_ids": _with(DESCRIBED, "SELECT path, chunk_index, cached_id FROM described"),
        "previews": _with(DESCRIBED, "SELECT path, chunk_index, content_preview FROM described"),
        "repo_labels": r"""
            SELECT page_id, url, CASE WHEN coalesce(url, '') = '' THEN 'unknown_repo' ELSE
              regexp_replace(regexp_replace(string_split(url, '/')[-1], '[.]git$', ''),
                '[^\p{L}\p{N}_-]', '_', 'g') END AS label FROM pages""",
        "sync_status": _with(
            f"{roots}, {KNOWN}",
            """SELECT path, root_hash, k.root_hash IS NULL AS needs_resync
              FROM roots LEFT JOIN known k USING (root_hash)""".replace(
                "SELECT path, root_hash, k", "SELECT path, roots.root_hash AS root_hash, k"
            ).replace("USING (root_hash)", "ON k.root_hash = roots.root_hash"),
        ),
        "index_chunks": _with(INDEX, "SELECT * EXCLUDE (true_start, true_end) FROM idx"),
        "index_true_lines": _with(INDEX, "SELECT * FROM idx"),
        "stored_index": _with(
            INDEX, "SELECT status, count(*) AS n_chunks, count(embedding_id) AS n_ids, "
            "count(DISTINCT original_file_path) AS n_files FROM idx GROUP BY status"
        ),
        "merged_indexes": _with(
            INDEX, "SELECT original_file_path, chunk_index, embedding_id, status FROM idx UNION ALL "
            "SELECT original_file_path, chunk_index, embedding_id, status FROM idx"
        ),
        "summary": _with(
            INDEX,
            """SELECT original_file_path AS file, chunk_index AS chunk,
              substr(obfuscated_file_path, 1, 20) || '...' AS obf_path, embedding_id AS emb_id,
              status FROM idx""",
        ),
        "file_diff": _with(SNAPSHOTS, "SELECT * FROM changes"),
        "tree_diff": _with(
            SNAPSHOTS,
            """SELECT coalesce(o.path, n.path) AS path, coalesce(o.pos, n.pos)::bigint AS pos,
              o.h AS old_hash, n.h AS new_hash
              FROM o_leaves o FULL OUTER JOIN n_leaves n ON o.path = n.path AND o.pos = n.pos
              WHERE o.h IS DISTINCT FROM n.h""",
        ),
        "chunk_diff": _with(
            f"""{SNAPSHOTS},
            sided AS (SELECT path, chunk_hash, 1 AS o, 0 AS n FROM o_hashed
              UNION ALL SELECT path, chunk_hash, 0, 1 FROM n_hashed),
            counted AS (SELECT path, chunk_hash, sum(o)::bigint AS n_old, sum(n)::bigint AS n_new
              FROM sided JOIN changes USING (path) WHERE change <> 'unchanged'
              GROUP BY path, chunk_hash)""",
            """SELECT path, chunk_hash, least(n_old, n_new) AS n_kept,
              greatest(n_new - n_old, 0) AS n_added, greatest(n_old - n_new, 0) AS n_removed
              FROM counted""",
        ),
        "reuse_embeddings": _with(
            f"""{DESCRIBED}, {_CACHE},
            firsts AS (SELECT chunk_hash, path, chunk_index, chunk,
                row_number() OVER (PARTITION BY chunk_hash ORDER BY path, chunk_index) AS rn,
                count(*) OVER (PARTITION BY chunk_hash) AS n_copies FROM described)""",
            """SELECT f.chunk_hash, path, chunk_index, chunk, n_copies, c.embedding,
              c.chunk_hash IS NULL AS needs_embedding
              FROM firsts f LEFT JOIN cache c ON c.chunk_hash = f.chunk_hash WHERE rn = 1""",
        ),
        "pending_chunks": _with(
            f"{DESCRIBED}, {_CACHE}",
            """SELECT chunk_hash, count(*) AS n_copies FROM described
              WHERE chunk_hash NOT IN (SELECT chunk_hash FROM cache) GROUP BY chunk_hash""",
        ),
        "manifest_latest": _with(
            f"{SNAPSHOTS}, {_RUNS}",
            """SELECT path, arg_max(run_id, run_id) AS run_id, arg_max(root_hash, run_id) AS root_hash,
              arg_max(n_chunks, run_id)::int AS n_chunks FROM run_rows GROUP BY path""",
        ),
        "source_tree": _with(_FILES, "SELECT path, content FROM files"),
        "rejected_files": """SELECT concat('doc_', doc_id, '.py') AS path, 'not valid UTF-8' AS error
            FROM documents WHERE doc_id % 7 = 3""",
        "stream_index": _with(
            _TWO_STATES,
            """SELECT batch_id, original_file_path, chunk_index, embedding_id, lines, status,
              root_hash FROM idx""",
        ),
        "stored_manifest": _with(
            _TWO_STATES,
            """SELECT original_file_path, chunk_index, embedding_id, lines, status
              FROM idx WHERE batch_id = 1""",
        ),
        "compacted_manifest": _with(
            f"""{_TWO_STATES},
            states AS (SELECT original_file_path AS path, batch_id + 1 AS run_id, root_hash,
                count(*) AS n_chunks, count(*) FILTER (status = 'failed') AS n_failed
              FROM idx WHERE batch_id < 2 GROUP BY original_file_path, batch_id, root_hash)""",
            """SELECT path, max(run_id)::bigint AS run_id, arg_max(root_hash, run_id) AS root_hash,
              arg_max(n_chunks, run_id)::int AS n_chunks, arg_max(n_failed, run_id) AS n_failed
              FROM states GROUP BY path""",
        ),
        "files_with_chunks": _with(
            f"{chunks}, {_CLASS_CHUNKS}",
            "SELECT path, count(*)::int AS n_chunks FROM c_hashed GROUP BY path",
        ),
        "files_with_root": _with(
            f"{chunks}, {_CLASS_CHUNKS}, {_roots('c_')}",
            "SELECT path, root_hash, n_chunks FROM c_roots",
        ),
    }
