"""SQL for the corpus queries that DuckDB can express."""

from __future__ import annotations

from meterflow.llm.licenses import NOTICES, SPELLINGS


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# A lower-cased line that begins with one of these ways of naming a right is a notice, told without looking ahead: DuckDB's
# patterns cannot. Words that follow "copyright" in prose are listed by hand, apart from the operator's own.
_HEAD = r"^[^\p{L}\p{N}]*"
_PROSE = (
    "a about agreement agreements an and any are applies as at be because but can claim claims disclaimer disclaimers doctrine "
    "doctrines does exception exceptions for from grant grants has have holder holders if in infringement infringements interest "
    "interests is issue issues it its law laws legislation licence license licences licenses line lines may must nor not notice "
    "notices of on or owner owners ownership patent patents permission permissions protection protects right rights rules shall "
    "should statement statements status such term terms than that this to trademark trademarks treaty treaties under was were "
    "which who will with without you your"
).split()
_FUNCTION = (
    "a all an any are as at be do does each every for from has have if in is it its may must no not of on or shall such that the "
    "their this to under use was when where which will with you your"
).split()
_THE = "software work works program library document material materials code".split()


def _is_notice(line: str) -> str:
    def matches(pattern: str, of: str = line) -> str:
        return f"regexp_matches({of}, {_quoted(pattern)})"

    dated = matches(_HEAD + r"((copyright|©|\(c\))[ \t:,-]*){1,4}(by[ \t]+)?([0-9]{4}([^0-9]|$)|[<\[{$%]|(year|yyyy)\b)")
    signed = matches(_HEAD + r"(copyright[ \t:]*(©|\(c\))|\(c\)[ \t]*copyright\b|©)[ \t:,-]*[\p{L}\p{N}]")
    named = matches(_HEAD + r"copyright[ \t:]+[\p{L}\p{N}]")
    prose = matches(_HEAD + rf"copyright[ \t:]+(({'|'.join(_PROSE)})\b|the[ \t]*$|the[ \t]+({'|'.join(_THE)})\b)")
    # A bare (c) before one to six words that are no function words, and then the end or a line on rights.
    words = f"regexp_extract_all(regexp_extract({line}, {_quoted(_HEAD + r'[(]c[)][ 	]+([^ 	,;].*)$')}, 1), '[^\\s,;]+[ \\t,;]*')"
    function = matches(rf"^({'|'.join(_FUNCTION)})\b", "w")
    first = f"least(6, coalesce(nullif(list_position(list_transform({words}, lambda w: {function}), true), 0) - 1, len({words})))"
    rest = f"array_to_string(list_slice({words}, {first} + 1, len({words})), '')"
    bare = f"({first} > 0 AND ({rest} = '' OR starts_with({rest}, 'all rights reserved')))"
    return f"({dated} OR {signed} OR ({named} AND NOT {prose}) OR {bare})"


def _canonical(text: str) -> str:
    lines = f"string_split(lower(coalesce({text}, '')), chr(10))"
    body = f"array_to_string(list_transform({lines}, lambda l: CASE WHEN {_is_notice('l')} THEN ' ' ELSE l END), chr(10))"
    body = rf"' ' || regexp_replace({body}, '[^\p{{L}}\p{{N}}]+', ' ', 'g') || ' '"
    for one, other in SPELLINGS:
        body = f"replace({body}, ' {one} ', ' {other} ')"
    return f"trim(regexp_replace({body}, ' +', ' ', 'g'))"


_KNOWN = ", ".join(f"({_quoted(name)}, {_quoted(body)})" for name, body in NOTICES)

ORACLES: dict[str, str] = {
    "op3_top_k": """
        WITH quantised AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
            FROM quantised a JOIN quantised b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
        )
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM scored QUALIFY rank <= 5
    """,
    "op4_licenses": f"""
        WITH known AS (
            SELECT sha256({_canonical('body')}) AS digest, min(name) AS license
            FROM (VALUES {_KNOWN}) AS t(name, body) GROUP BY 1
        ), lines AS (
            SELECT DISTINCT rowid_, k.license FROM (
                SELECT row_number() OVER () AS rowid_, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents
            ) JOIN known k ON k.digest = sha256({_canonical('line')})
        ), named AS (
            SELECT rowid_, string_agg(license, ',' ORDER BY license) AS line_licenses FROM lines GROUP BY 1
        ), numbered AS (
            SELECT row_number() OVER () AS rowid_, doc_id, sha256({_canonical('text')}) AS text_digest FROM documents
        )
        SELECT doc_id, text_digest, k.license, coalesce(n.line_licenses, '') AS line_licenses
        FROM numbered LEFT JOIN known k ON k.digest = text_digest LEFT JOIN named n USING (rowid_)
    """,
    "op9_exact_dedup": r"""
        WITH digests AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256,
                   length(coalesce(text, '')) AS n, row_number() OVER () AS uid FROM documents
        ), ranked AS (
            SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM digests WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST, uid)
        )
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
    """,
}
