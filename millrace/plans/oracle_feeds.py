"""The feeds of ``feeds`` written again in DuckDB SQL, for the oracles.

``sql("select ... from f_docs")`` puts the common table expressions a query needs
in front of it.
"""

from __future__ import annotations

import re

from millrace import schemas as S
from millrace.functions import chunks as C
from millrace.functions import text as X
from millrace.plans import feeds


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def values(names: list[str]) -> str:
    return ", ".join(lit(n) for n in names)


def listing(names: list[str]) -> str:
    return f"[{values(names)}]"


def rule(expr: str, spec: tuple[str, str, str]) -> str:
    flags, pattern, replacement = spec
    prefix = f"(?{flags})" if flags else ""
    target = re.sub(r"\$(\d)", r"\\\1", replacement)
    return f"regexp_replace({expr}, {lit(prefix + pattern)}, {lit(target)}, 'g')"


def rules(expr: str, specs: list[tuple[str, str, str]]) -> str:
    for spec in specs:
        expr = rule(expr, spec)
    return expr


def strip(expr: str) -> str:
    return rule(expr, ("", rf"\A[{X.SPACE}]+|[{X.SPACE}]+\z", ""))


def blank(expr: str) -> str:
    return f"({expr} IS NULL OR NOT regexp_matches({expr}, {lit(f'[^{X.SPACE}]')}))"


def unwrap(expr: str) -> str:
    """By lines: first line out, last line out if it is a bare fence."""
    lines = "string_split(b, chr(10))[2:]"
    kept = f"CASE WHEN {strip(f'{lines}[-1]')} = '```' THEN {lines}[:-2] ELSE {lines} END"
    inner = strip(f"array_to_string({kept}, chr(10))")
    return f"list_transform([{strip(expr)}], lambda b: CASE WHEN starts_with(b, '```') THEN {inner} ELSE b END)[1]"


def markdown(expr: str) -> str:
    return f"replace({unwrap(rules(expr, X.MARKDOWN_RULES))}, '`', '')"


def html(expr: str) -> str:
    return strip(rules(expr, X.HTML_RULES))


def emoji(expr: str) -> str:
    return rules(expr, [X.KEYCAP_RULE, X.EMOJI_RULE])


def escape(expr: str) -> str:
    """Character by character, unlike the run-wise Spark form."""
    short = " ".join(f"WHEN {lit(c)} THEN {lit(e)}" for c, e in X.SHORT_ESCAPES)
    return f"""coalesce(array_to_string(list_transform(string_split({expr}, ''), lambda c: CASE c {short} ELSE
        CASE WHEN c = '' THEN '' WHEN unicode(c) BETWEEN 32 AND 126 THEN c
             WHEN unicode(c) < 65536 THEN printf('\\u%04x', unicode(c))
             ELSE printf('\\u%04x\\u%04x', 55296 + ((unicode(c) - 65536) >> 10), 56320 + ((unicode(c) - 65536) & 1023)) END
        END), ''), '')"""


def readable(expr: str) -> str:
    return emoji(html(markdown(f"coalesce({expr}, '')")))


def heading(expr: str, before: str) -> str:
    found = lambda text, pattern: f"regexp_matches({text}, {lit(pattern)})"
    return (
        f"({found(expr, C.HEADING_MARK)} OR {found(expr, C.SECTION)}"
        f" OR ({found(expr, C.LABEL_END)} AND NOT {found(expr, C.SENTENCE_INSIDE)})"
        f" OR ({found(expr, C.TITLE)} AND coalesce(NOT {found(before, C.BARE_END)} AND NOT {found(before, C.LABEL_END)}, true)))"
    )


def score(expr: str, category: str) -> str:
    return f"len(regexp_extract_all({expr}, {lit(C.cue_pattern(category))}))"


def category(expr: str) -> str:
    """First category, in cue order, that reaches the best score."""
    scores = "[" + ", ".join(score(expr, name) for name in C.CUES) + "]"
    return (
        f"list_transform([{scores}], lambda s: CASE WHEN list_max(s) = 0 THEN {lit(C.FALLBACK)} "
        f"ELSE {listing(list(C.CUES))}[list_position(s, list_max(s))] END)[1]"
    )


def _content() -> str:
    whens = "\n".join(
        f"WHEN {k} THEN {lit(before)} || text || {lit(after)}" for k, (before, after) in feeds.DECORATIONS.items()
    )
    return f"CASE doc_id % 16 {whens} ELSE text END"


def _pick(names: list[str], index: str) -> str:
    return f"{listing(names)}[CAST(({index}) % {len(names)} AS INT) + 1]"


def _keywords() -> str:
    parts = []
    for n, name in enumerate(S.KEYWORD_LISTS):
        parts.append(
            f"CASE (doc_id + {n}) % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST([] AS VARCHAR[]) "
            f"ELSE [lang, 'kw-' || CAST((doc_id + {n}) % 10 AS VARCHAR)] END AS {name}"
        )
    parts.append("CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'strong' END AS keywordsStrength")
    parts.append("CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'cold' END AS keywordsTemperature")
    return ", ".join(parts)


CTES = {
    "f_docs": f"""
        SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, lang, source, n_chars, text, {_content()} AS content,
               TIMESTAMP '{feeds.BASE_INSTANT}' + to_minutes(CAST(n_chars AS BIGINT)) AS version
        FROM documents""",
    "f_published": "SELECT * FROM f_docs WHERE doc_id IN (SELECT doc_id FROM labels)",
    "f_events": "SELECT event_id, ts, user_id, CAST(user_id AS VARCHAR) AS id, event_type, value, props FROM events",
    "f_event_items": f"""
        SELECT *, {feeds.EVENT_ITEM_SQL} AS item
        FROM (SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso FROM f_events)""",
    "f_messages": f"SELECT *, {feeds.EVENT_VALUE_SQL} AS body, event_id % 13 = 0 AS damaged FROM f_event_items",
    # text as far as it decodes; items as JSON values
    "f_decoded": """
        SELECT event_id, user_id, event_type, ts, body, damaged AND body IS NOT NULL AS bad_bytes,
               CASE WHEN NOT damaged THEN body END AS text,
               CASE WHEN NOT damaged AND json_valid(body) THEN CAST(body AS JSON) END AS payload
        FROM f_messages""",
    "f_itemized": """
        SELECT *, CASE WHEN json_type(payload, '$.data') = 'ARRAY' THEN CAST(payload -> '$.data' AS JSON[])
                       WHEN json_type(payload) = 'ARRAY' THEN CAST(payload AS JSON[]) END AS items
        FROM f_decoded""",
    "f_items": """
        SELECT event_id, unnest(range(len(items))) AS item_pos, unnest(items) AS item
        FROM f_itemized WHERE len(items) > 0""",
    "f_lines": """
        SELECT doc_id, pos - 1 AS pos, span FROM (
          SELECT doc_id, unnest(string_split(content, chr(10))) AS span,
                 generate_subscripts(string_split(content, chr(10)), 1) AS pos FROM f_docs)
        WHERE NOT """
    + blank("span"),
    # block number = lines of plain text before this one; trailing headings fall back to the last block
    "f_line_blocks": f"""
        SELECT doc_id, pos, span, CASE WHEN plain_before = plain_all AND plain_all > 0 THEN plain_all - 1
                                       ELSE plain_before END AS block
        FROM (SELECT *, sum(plain) OVER (PARTITION BY doc_id) AS plain_all,
                     coalesce(sum(plain) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS plain_before
              FROM (SELECT doc_id, pos, span, CASE WHEN {heading("span", "above")} THEN 0 ELSE 1 END AS plain
                    FROM (SELECT *, lag(span) OVER (PARTITION BY doc_id ORDER BY pos) AS above FROM f_lines)))""",
    "f_blocks": f"""
        SELECT doc_id, block, block_text, n_lines, {category("block_text")} AS category
        FROM (SELECT doc_id, block, string_agg(span, chr(10) ORDER BY pos) AS block_text, count(*) AS n_lines
              FROM f_line_blocks GROUP BY doc_id, block)""",
    "f_chunk_rows": """
        SELECT doc_id, category, content, row_number() OVER (PARTITION BY doc_id ORDER BY first_block) - 1 AS chunk_pos
        FROM (SELECT doc_id, category, min(block) AS first_block, string_agg(block_text, chr(10) ORDER BY block) AS content
              FROM f_blocks GROUP BY doc_id, category)""",
    "f_chunked": """
        SELECT d.doc_id, d.content, coalesce(c.chunks, []) AS chunks FROM f_docs d
        LEFT JOIN (SELECT doc_id, list({'category': category, 'content': content} ORDER BY chunk_pos) AS chunks
                   FROM f_chunk_rows GROUP BY doc_id) c USING (doc_id)""",
    "f_altered": """
        SELECT doc_id, content, chunks, CASE doc_id % 13
          WHEN 8 THEN [{'category': 'mystery', 'content': chunks[1].content}] || chunks[2:]
          WHEN 9 THEN chunks || [{'category': 'other', 'content': ' ' || chr(9)}]
          WHEN 10 THEN chunks[2:]
          WHEN 11 THEN chunks || [{'category': 'other', 'content': chunks[1].content}]
          WHEN 12 THEN [{'category': chunks[1].category, 'content': chunks[1].content || ' (sic)'}] || chunks[2:]
          ELSE chunks END AS altered
        FROM f_chunked""",
    "f_answered": """
        SELECT doc_id, content, CASE doc_id % 13
            WHEN 1 THEN cut WHEN 5 THEN cut WHEN 2 THEN '{"chunks":' || good || '}'
            WHEN 3 THEN CAST(to_json(list_transform(altered, lambda c: {'category': c.category})) AS VARCHAR)
            WHEN 4 THEN CAST(to_json(list_transform(altered, lambda c: {'category': c.category, 'content': c.content, 'note': 'y'})) AS VARCHAR)
            WHEN 6 THEN '' WHEN 7 THEN '[]' ELSE good END AS first_answer,
          CASE doc_id % 13 WHEN 1 THEN good WHEN 5 THEN cut END AS second_answer
        FROM (SELECT *, good[1:-2] AS cut
              FROM (SELECT *, CAST(to_json(altered) AS VARCHAR) AS good FROM f_altered))""",
    # chunk rows of every answer that parses with exact keys at the first or the repair try
    "f_answer_rows": """
        SELECT doc_id, unnest(range(len(altered))) AS chunk_pos, unnest(altered, recursive := true)
        FROM f_altered WHERE doc_id % 13 NOT IN (2, 3, 4, 5, 6, 7)""",
    "f_records": f"""
        SELECT *, CASE WHEN ratingCount > 0 THEN round(totalStars / ratingCount, 4) ELSE 0.0 END AS rating FROM (
        SELECT doc_id, id, lang, source, content, version AS modifiedOn, n_chars,
          'Record ' || id AS title, source || ': record ' || id AS descriptiveTitle,
          lang || ' text from ' || source AS description, doc_id % 4 + 1 AS serves, n_chars % 20 + 3 AS prepTimeMinutes,
          doc_id % 3 = 0 AS isIba,
          CASE WHEN doc_id % 2 = 0 THEN ['tile', 'detail'] ELSE ['tile'] END AS image_types,
          [{_pick(S.GLASSWARE, "doc_id")}, {_pick(S.GLASSWARE, "doc_id * 7")}] AS glassware,
          doc_id % 3 + doc_id % 2 * 2 + doc_id % 5 * 3 + doc_id % 7 * 4 + doc_id % 11 * 5 AS totalStars,
          doc_id % 3 + doc_id % 2 + doc_id % 5 + doc_id % 7 + doc_id % 11 AS ratingCount,
          doc_id % 9 AS reaction_like, doc_id % 4 AS reaction_save,
          {_keywords()}
        FROM f_docs)""",
    "f_record_items": f"""
        SELECT doc_id, i AS item_pos, 'item-' || n AS item_id, 'Item ' || n AS name,
          CASE WHEN doc_id % 23 = 5 AND i = 0 THEN 'gallons' ELSE {_pick(S.UNITS, "doc_id + i")} END AS uoM,
          {_pick(S.REQUIREMENTS, "doc_id + i")} AS requirement,
          CAST(i + 1 AS VARCHAR) || ' of item ' || n AS display, CAST((i + 1) * 0.5 AS DOUBLE) AS units,
          {_pick(S.PREPARATIONS, "doc_id + i")} AS preparation,
          'kind-' || CAST(n % 7 AS VARCHAR) AS kind,
          {_pick(S.TAXONOMY_GROUPS, "doc_id + i")} AS taxonomyFilterType,
          {_pick(S.APPLICATIONS, "doc_id + i")} AS application
        FROM (SELECT doc_id, i, CAST((doc_id * (i + 3)) % 97 AS BIGINT) AS n
              FROM (SELECT doc_id, unnest(range(0, doc_id % 3 + 2)) AS i FROM documents))""",
    "f_order_items": """
        SELECT l_orderkey AS record_id, l_linenumber AS position, l_partkey AS item_id, l_quantity AS units,
          CASE l_returnflag WHEN 'R' THEN 'garnishment' WHEN 'A' THEN 'base' ELSE 'additional' END AS application
        FROM lineitem""",
    "f_vectors": """
        SELECT vec_id AS chunk_id, CAST(label AS VARCHAR) AS record_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings""",
    "f_requests": "SELECT record_id AS request_id, arg_min(v, chunk_id) AS q FROM f_vectors GROUP BY record_id",
    "f_scores": """
        SELECT request_id, record_id, chunk_id, round(list_cosine_similarity(v, q), 6) AS score
        FROM f_vectors CROSS JOIN f_requests""",
}


def sql(query: str, **extra: str) -> str:
    """``query`` with the CTEs it names, directly or through others, in front."""
    known = {**CTES, **extra}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\bf_\w+", text)):
            if name in known and name not in order:
                visit(known[name])
                order.append(name)

    visit(query)
    if not order:
        return query
    return "WITH " + ",\n".join(f"{name} AS ({known[name]})" for name in order) + "\n" + query
