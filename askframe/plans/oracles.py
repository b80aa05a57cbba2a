"""The same answers in SQL over the same tables, written independently."""

from __future__ import annotations

from askframe.plans.queries import DAY, PATTERNS

PAGES = """
pages_as_paths AS (
    SELECT page_id, regexp_replace(url, '^[a-z]+://|[?#].*$', '', 'g') AS path FROM pages
),
parts AS (
    SELECT page_id, rtrim(path, '/') AS path,
           regexp_extract(rtrim(path, '/'), '([^/]*)$', 1) AS name,
           CASE WHEN contains(rtrim(path, '/'), '/')
                THEN rtrim(regexp_replace(rtrim(path, '/'), '[^/]*$', ''), '/')
                ELSE '.' END AS parent
    FROM pages_as_paths
)"""

# Directories and files below hosts, with the host, the entry directly below it, and the rest of the path.
SITES = f"""
{PAGES.strip()}, placed_pages AS (
    SELECT DISTINCT split_part(path, '/', 1) AS home,
           CASE WHEN page_id % 3 = 0 THEN CASE WHEN page_id % 2 = 1 THEN name ELSE 'x' || name END
                ELSE CASE WHEN page_id % 2 = 1 THEN upper(split_part(path, '/', 2)) ELSE split_part(path, '/', 2) END END AS top,
           CASE WHEN page_id % 3 = 0 THEN '' ELSE '/' || name END AS rest
    FROM parts
), sites AS (
    SELECT home, top, rest, 'file' AS kind FROM placed_pages
    UNION ALL SELECT DISTINCT home, top, '', 'dir' FROM placed_pages WHERE rest <> ''
)"""

FIXED_PATTERNS = "patterns(pattern) AS (VALUES " + ", ".join(f"('{p}')" for p in PATTERNS) + ")"

GREETING = """
SELECT c_custkey, c_name AS name, CAST(c_nationkey AS BIGINT) AS age,
       CAST(c_nationkey + 1 AS BIGINT) AS age_next,
       'Привет, ' || c_name || '! Через год тебе будет ' || (c_nationkey + 1) || ' лет.' AS message
FROM customer"""

SOURCE_REQUESTS = "requests AS (SELECT 'src' || n_nationkey AS dir FROM nation)"


def newlines(text: str) -> str:
    return f"CAST(length({text}) - length(replace({text}, chr(10), '')) AS BIGINT)"


def second_run(name: str) -> str:
    return f"""
WITH entries AS (SELECT {name} AS name, s_suppkey AS content FROM supplier),
before AS (
    SELECT * FROM entries
    UNION ALL SELECT 'backup_' || name, content + 1000000 FROM entries
    UNION ALL SELECT '.index', max(content) FROM entries
),
sources AS (
    SELECT name, content, regexp_replace(name, '^(backup_)+', '') AS root FROM before WHERE name NOT LIKE '.%'
),
chains AS (
    SELECT *, (length(name) - length(root)) // 7
              - row_number() OVER (PARTITION BY root ORDER BY length(name)) AS chain
    FROM sources
),
copies AS (
    SELECT 'backup_' || name AS name,
           CASE WHEN root < 'backup_' || root
                THEN first_value(content) OVER (PARTITION BY root, chain ORDER BY length(name))
                ELSE content END AS content
    FROM chains
)
SELECT name, content FROM before WHERE name NOT IN (SELECT name FROM copies)
UNION ALL SELECT name, content FROM copies"""


ORACLES: dict[str, str] = {
    "next_year_greeting": GREETING,
    "greeting_stream": GREETING,
    "greeting_files": f"SELECT message FROM ({GREETING})",
    "greeting_bad_age": """
SELECT p_partkey, split_part(line, ' ', 1) AS name, substr(line, strpos(line, ' ') + 1) AS age_text,
       TRY_CAST(substr(line, strpos(line, ' ') + 1) AS BIGINT) AS age
FROM (SELECT p_partkey, p_name || ' ' || p_size AS line FROM part)""",
    "find_name_exists": f"""
WITH {PAGES}, {FIXED_PATTERNS}, checked AS (
    SELECT pattern, pattern <> '' AND EXISTS (SELECT 1 FROM parts WHERE name GLOB pattern) AS found FROM patterns
)
SELECT pattern, found,
       'Файл ''' || pattern || CASE WHEN found THEN ''' найден' ELSE ''' не найден' END AS message
FROM checked""",
    "find_one_name": f"""
WITH {PAGES} SELECT '{PATTERNS[0]}' AS pattern, count(*) > 0 AS found FROM parts WHERE name GLOB '{PATTERNS[0]}'""",
    "find_name_matches": f"""
WITH {PAGES}, {FIXED_PATTERNS}
SELECT pattern FROM patterns
WHERE pattern <> '' AND EXISTS (SELECT 1 FROM parts WHERE name GLOB pattern)""",
    "find_many_names": f"""
WITH {PAGES}, requests AS (
    SELECT p_partkey, unnest([
        p_partkey || '.html', p_size || '*.html', '?*' || p_size, '[' || left(CAST(p_size AS VARCHAR), 1) || ']??*'
    ]) AS pattern FROM part
),
names AS (SELECT DISTINCT name FROM parts),
found AS (
    SELECT pattern FROM (SELECT DISTINCT pattern FROM requests)
    WHERE EXISTS (SELECT 1 FROM names WHERE name GLOB pattern)
)
SELECT p_partkey, r.pattern, f.pattern IS NOT NULL AS found,
       'Файл ''' || r.pattern || CASE WHEN f.pattern IS NULL THEN ''' не найден' ELSE ''' найден' END AS message
FROM requests r LEFT JOIN found f ON r.pattern = f.pattern""",
    "file_manifest": f"WITH {PAGES} SELECT path, parent, name, 'file' AS kind FROM parts",
    "directory_listing": f"WITH {PAGES} SELECT DISTINCT parent, name FROM parts WHERE name NOT LIKE '.%' AND page_id % 10 <> 0",
    "tree_directories": "SELECT DISTINCT 'lang=' || lang AS name FROM documents",
    "missing_directory_reject": f"""
WITH {SOURCE_REQUESTS}
SELECT dir, 'Дирректория ''' || dir || ''' не найдена!' AS message FROM requests
WHERE NOT EXISTS (SELECT 1 FROM documents WHERE source = dir)""",
    "present_directory": f"""
WITH {SOURCE_REQUESTS}
SELECT dir FROM requests WHERE EXISTS (SELECT 1 FROM documents WHERE source = dir)""",
    "snapshot_answers": f"""
WITH {SOURCE_REQUESTS}, checked AS (
    SELECT dir, dir || '_{DAY}.tar.gz' AS archive, dir IN (SELECT source FROM documents) AS known FROM requests
)
SELECT dir, CASE WHEN known THEN archive END AS archive_name,
       CASE WHEN known THEN 'planned' ELSE 'not_found' END AS status,
       CASE WHEN NOT known THEN 'Дирректория ''' || dir || ''' не найдена!' END AS message
FROM checked""",
    "taken_snapshots": f"""
WITH {SOURCE_REQUESTS}, sizes AS (SELECT source, count(*) AS records FROM documents GROUP BY source)
SELECT dir AS source, CASE WHEN records IS NOT NULL THEN dir || '_{DAY}.tar.gz' END AS archive_name,
       CASE WHEN records IS NULL THEN 'not_found' ELSE 'ok' END AS status,
       CASE WHEN records IS NULL THEN 'Дирректория ''' || dir || ''' не найдена!'
            ELSE 'Архив создан: ' || dir || '_{DAY}.tar.gz' END AS message,
       records
FROM requests LEFT JOIN sizes ON source = dir""",
    "path_parts": f"WITH {PAGES} SELECT page_id, name AS base, parent AS dir FROM parts",
    "dated_archive_name": """
SELECT o_orderkey, o_orderkey || '_' || strftime(o_orderdate, '%Y-%m-%d') || '.tar.gz' AS archive_name FROM orders""",
    "dated_snapshot": f"SELECT doc_id, source, DATE '{DAY}' AS snapshot_date FROM documents",
    "dated_dataset": f"""
SELECT *, CASE c_custkey % 2 WHEN 0 THEN 'a' ELSE '[ab]' END || '_{DAY}' AS archive FROM customer""",
    "newline_count": f"SELECT doc_id, {newlines('text')} AS newline_count FROM documents",
    "newline_count_conversations": f"SELECT conv_id, turn, {newlines('text')} AS newline_count FROM conversations",
    "newline_count_pages": f"SELECT page_id, {newlines('html')} AS newline_count FROM pages",
    "newline_total_by_source": f"""
SELECT source, CAST(sum({newlines('text')}) AS BIGINT) AS newline_count FROM documents GROUP BY source""",
    "newline_total": f"SELECT CAST(sum({newlines('text')}) AS BIGINT) AS newline_count FROM documents",
    "file_newline_count": f"""
SELECT lang, CAST(sum({newlines('text')} + 1) AS BIGINT) AS newline_count FROM documents GROUP BY lang""",
    "file_newline_answers": f"""
SELECT lang, CAST(sum({newlines('text')} + 1) AS BIGINT) AS newline_count FROM documents GROUP BY lang""",
    "file_newline_requests": f"""
WITH counted AS (SELECT source, CAST(sum({newlines('text')} + 1) AS BIGINT) AS newline_count FROM documents GROUP BY source)
SELECT source, 'ok' AS status, newline_count FROM counted
UNION ALL SELECT source, unnest(['not_found', 'no_request']), NULL FROM counted""",
    "prefix_backup_first_run": """
SELECT s_name AS name, s_suppkey AS content FROM supplier
UNION ALL SELECT 'backup_' || s_name, s_suppkey FROM supplier""",
    "backup_by_kind": """
WITH entries AS (
    SELECT p_name || '-' || p_partkey AS name,
           CASE p_type WHEN 'SMALL' THEN 'dir' WHEN 'ECONOMY' THEN 'other' ELSE 'file' END AS kind, p_size
    FROM part
)
SELECT name, kind, p_size FROM entries
UNION ALL SELECT 'backup_' || name, kind, p_size FROM entries WHERE kind <> 'other'""",
    "prefix_backup_second_run": second_run("s_name"),
    "prefix_backup_second_run_lower": second_run("lower(s_name)"),
    "requested_backup": f"""
WITH {PAGES}, wanted AS (
    SELECT min(parent) AS parent FROM parts
    GROUP BY CASE WHEN contains(parent, '/') THEN regexp_replace(parent, '/[^/]*$', '') ELSE '.' END
),
before AS (SELECT DISTINCT parent, name, path FROM parts WHERE parent IN (SELECT parent FROM wanted))
SELECT parent, name, path FROM before
UNION ALL SELECT parent, 'backup_' || name, path FROM before""",
    "backup_answers": """
WITH checked AS (
    SELECT 'src' || n_nationkey || '/' AS dir,
           ('src' || n_nationkey) IN (SELECT source FROM documents) AS known FROM nation
)
SELECT dir, CASE WHEN known THEN 'ok' ELSE 'not_found' END AS status,
       CASE WHEN NOT known THEN 'Директория не найдена!' END AS message
FROM checked""",
    "implied_tree": f"""
WITH {PAGES}, split AS (SELECT path, string_split(path, '/') AS names FROM parts),
above AS (
    SELECT DISTINCT array_to_string(names[1:i], '/') AS path FROM split, unnest(range(1, len(names))) r(i)
    UNION SELECT '.'
)
SELECT path, CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') ELSE '.' END AS parent,
       regexp_extract(path, '[^/]*$') AS name
FROM above WHERE path NOT IN (SELECT path FROM parts)""",
    "tree_backup": f"""
WITH {SITES}
SELECT home || '/' || top || rest AS path, kind, home || '/' || top || rest AS origin FROM sites
UNION ALL SELECT home || '/backup_' || top || rest, kind, home || '/' || top || rest FROM sites""",
    "tree_backup_second_run": f"""
WITH {SITES}, placed AS (
    SELECT *, home || '/' || top || rest AS own, home || '/backup_' || top || rest AS copy,
           rest <> '' OR kind = 'dir' AS deep, top < 'backup_' || top AS early
    FROM sites
)
SELECT own AS path, kind, own AS origin FROM placed
UNION ALL SELECT copy, kind, CASE WHEN deep THEN copy ELSE own END FROM placed
UNION ALL SELECT home || '/backup_' || top || '/' || top || rest, kind, own FROM placed WHERE deep
UNION ALL SELECT home || '/backup_backup_' || top || rest, kind, CASE WHEN NOT deep AND early THEN own ELSE copy END FROM placed
UNION ALL SELECT home || '/backup_backup_' || top || '/' || top || rest, kind, own FROM placed WHERE deep AND early""",
    "file_backup": f"""
WITH lines AS (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents),
shown AS (
    SELECT lang AS part, count(*) AS lines, CAST(sum(('0x' || left(md5(line), 8))::BIGINT) AS BIGINT) AS checksum
    FROM lines GROUP BY lang
)
SELECT place, part, lines, checksum
FROM (SELECT * FROM shown UNION ALL SELECT '.hidden', CAST(sum({newlines('text')} + 1) AS BIGINT), NULL FROM documents),
     (VALUES ('notes'), ('backup_notes'), ('backup_notes/notes'), ('backup_backup_notes')) p(place)""",
    "dataset_backup": """
SELECT prefix || name AS dataset, s_suppkey, s_nationkey
FROM supplier, (VALUES (''), ('backup_'), ('backup_backup_')) p(prefix), (VALUES ('Supplier'), ('supplier'), ('[Ss]upplier')) n(name)
WHERE name <> '[Ss]upplier' OR s_suppkey % 2 = 0""",
    "dataset_backup_answers": """
SELECT name, status, CASE WHEN status = 'ok' THEN (SELECT count(*) FROM supplier) END AS records
FROM (VALUES ('first', 'ok'), ('note', 'failed'), ('second', 'ok')) v(name, status)""",
    "greeting_statuses": """
WITH aged AS (
    SELECT p_partkey, CASE WHEN p_size > 40 THEN 9223372036854775807 WHEN p_size <= 20 THEN p_size::BIGINT END AS age FROM part
)
SELECT p_partkey, age, CASE WHEN age < 100 THEN 'ok' ELSE 'bad_age' END AS status,
       CASE WHEN age < 100 THEN 'Привет, x! Через год тебе будет ' || (age + 1) || ' лет.' END AS message
FROM aged""",
}
