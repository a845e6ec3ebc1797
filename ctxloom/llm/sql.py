"""The same results in SQL, where SQL can express them."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _decontaminate(window: int) -> str:
    return f"""
        WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_words("text")} AS w FROM documents),
          b AS (SELECT item_id::VARCHAR AS item, {_words("text")} AS w FROM benchmark),
          windows AS (SELECT DISTINCT item, least(len(w), {window}) AS m,
                             w[i : i + least(len(w), {window}) - 1] AS words
                      FROM (SELECT *, unnest(range(1, len(w) - least(len(w), {window}) + 2)) AS i FROM b WHERE len(w) > 0)),
          lengths AS (SELECT DISTINCT m FROM windows),
          places AS (SELECT k, m, i, w[i : i + m - 1] AS words
                     FROM (SELECT k, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lengths WHERE len(w) >= m)),
          hits AS (SELECT k, p.m, i, item FROM places p JOIN windows v ON p.m = v.m AND p.words = v.words),
          covered AS (SELECT k, count(DISTINCT place)::BIGINT AS n_hit
                      FROM (SELECT k, unnest(range(i, i + m)) AS place FROM hits) GROUP BY k),
          items AS (SELECT k, count(DISTINCT item)::BIGINT AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names
                    FROM hits GROUP BY k)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN covered USING (k) LEFT JOIN items USING (k)"""


# The characters that are white space.
_SPACES = r"\x{9}-\x{d}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _line_dedup(least: int) -> str:
    return f"""
        WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
          l AS (SELECT doc_id, i, lines[i] AS line FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM d)),
          own AS (SELECT * FROM l WHERE regexp_matches(line, '[^{_SPACES}]')),
          firsts AS (SELECT line, min({{'d': doc_id, 'i': i}}) AS first FROM own GROUP BY line),
          long AS (SELECT * FROM firsts WHERE length(line) >= {least}),
          cut AS (SELECT line, first, k, hash(left(line, k - 1) || substr(line, k + 1)) AS v
                  FROM (SELECT *, unnest(range(1, length(line) + 1)) AS k FROM long)),
          place AS (SELECT v, k, min(first) AS first FROM cut GROUP BY v, k),
          whole AS (SELECT hash(line) AS v, first, line FROM long),
          near AS (SELECT line FROM cut JOIN place USING (v, k) WHERE place.first < cut.first
                   UNION SELECT cut.line FROM cut JOIN whole USING (v) WHERE whole.first < cut.first
                   UNION SELECT whole.line FROM cut JOIN whole USING (v) WHERE cut.first < whole.first),
          gone AS (SELECT doc_id, i FROM own JOIN firsts USING (line)
                   WHERE {{'d': doc_id, 'i': i}} > first OR line IN (SELECT line FROM near)),
          kept AS (SELECT doc_id, count(*) FILTER ((doc_id, i) IN (SELECT (doc_id, i) FROM gone)) AS n,
                          string_agg(line, chr(10) ORDER BY i) FILTER ((doc_id, i) NOT IN (SELECT (doc_id, i) FROM gone)) AS text
                   FROM l GROUP BY doc_id)
        SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_removed,
               CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept.text, '')) END AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)"""


_ESCAPES = (
    "length({0}) - length(replace({0}, '\\', '')) + (length({0}) - length(replace({0}, '</turn>', ''))) // 7"
    " + coalesce(list_sum(list_transform(regexp_extract_all({0}, '#{{3,}}'), lambda r: length(r) - 2)), 0)"
)

_CHAT = f"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, k, if(k = 0, 'user', 'assistant'), '\\### Assistant: </turn> ok' FROM range(2) t(k))
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(14 + length(text) + {_ESCAPES.format("text")} + length(role) + {_ESCAPES.format("role")}
               + (length(role) - length(replace(role, ': ', ''))) // 2)::BIGINT AS formatted_chars
    FROM c GROUP BY conv_id"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_field(v) for v in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}::VARCHAR, ''),
    lambda ch: [ord(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""


def _levels(name: str, foot: str) -> str:
    """Recursive CTE (grp, lvl, pos, node, n): the levels of each group's tree."""
    return f"""{name} AS ({foot} UNION ALL
            SELECT grp, lvl + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (max(n) + 1) // 2
            FROM {name} WHERE n > 1 GROUP BY grp, lvl, pos // 2)"""


_MERKLE = f"""
    WITH RECURSIVE d AS (SELECT row_number() OVER () AS k, doc_id, coalesce('=' || lang, '') AS grp, {_leaf("n_chars")} AS leaf,
            CASE WHEN {_CRC32.format("doc_id")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} END AS altered FROM documents),
      placed AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                        count(*) OVER (PARTITION BY grp) AS n FROM d),
      {_levels("tree", "SELECT grp, 0 AS lvl, pos, leaf AS node, n FROM placed")},
      subroots AS (SELECT grp AS name, node, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
      {_levels("above", "SELECT 'top' AS grp, 0 AS lvl, pos, node, n FROM subroots")},
      own AS (SELECT p.k, t.lvl, p.pos >> t.lvl AS pos, t.grp, t.n FROM placed p
              JOIN (SELECT DISTINCT grp, lvl, n FROM tree WHERE n > 1) t ON p.grp = t.grp),
      upper AS (SELECT p.k, t.lvl, s.pos >> t.lvl AS pos, t.n FROM placed p JOIN subroots s ON p.grp = s.name
                CROSS JOIN (SELECT DISTINCT lvl, n FROM above WHERE n > 1) t),
      steps AS (SELECT k, o.lvl, o.pos % 2 AS side, t.node FROM own o
                LEFT JOIN tree t ON t.grp = o.grp AND t.lvl = o.lvl AND t.pos = xor(o.pos, 1)
                UNION ALL SELECT k, 1000 + o.lvl, o.pos % 2, t.node FROM upper o
                LEFT JOIN above t ON t.lvl = o.lvl AND t.pos = xor(o.pos, 1)),
      paths AS (SELECT k, list(CASE WHEN node IS NULL THEN '-' WHEN side = 1 THEN 'L' || node ELSE 'R' || node END ORDER BY lvl) AS path,
                       string_agg(node, '' ORDER BY lvl) AS siblings FROM steps GROUP BY k),
      folded AS (SELECT p.*, siblings, list_reduce(list_prepend(coalesce(altered, leaf), coalesce(path, [])),
                     lambda x, s: CASE s[1] WHEN '-' THEN sha256(x) WHEN 'L' THEN sha256(s[2:] || x) ELSE sha256(x || s[2:]) END) AS folded_root
                 FROM placed p LEFT JOIN paths USING (k)),
      root AS (SELECT node AS root FROM above WHERE n = 1)
    SELECT doc_id, leaf, s.node AS subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root,
           folded_root = root AS verified
    FROM folded f JOIN subroots s ON f.grp = s.name CROSS JOIN root"""


def llm_sql() -> dict[str, str]:
    return {"op3_chat_format": _CHAT, "op2_line_dedup": _line_dedup(20), "op6_decontaminate": _decontaminate(10),
            "op12_merkle_manifest": _MERKLE}
