"""SQL builders for the DuckDB oracles of the text operators.

They spell the same analysis contract as :mod:`quarry.functions.text` in
plain SQL (``unnest`` of the token list, ``CASE`` stemmer, ``NOT IN`` stop
list), so DuckDB checks the Spark expressions independently.
"""

from __future__ import annotations

from quarry.functions.text import TOKEN_PATTERN, sql_stem, sql_stop_list, sql_string_list
from quarry.operators.search import Clause, parse_query


def terms_cte(table: str, id_expr: str, text_expr: str, name: str = "terms") -> str:
    """CTE ``name(id, pos, term)``: analysed terms of each row, in order."""
    return (
        f"{name}_tok AS (SELECT {id_expr} AS id, "
        f"unnest(regexp_extract_all(lower(coalesce({text_expr}, '')), '{TOKEN_PATTERN}')) AS t "
        f"FROM {table}), "
        f"{name} AS (SELECT id, {sql_stem('t')} AS term FROM {name}_tok "
        f"WHERE t NOT IN ({sql_stop_list()}))"
    )


def clause_test(c: Clause, x: str) -> str:
    if c.kind == "prefix":
        return f"starts_with({x}, '{c.terms[0]}')"
    if c.kind == "any":
        return f"{x} IN ({sql_string_list(c.terms)})"
    return f"{x} = '{c.terms[0]}'"


def fts_scores_sql(table: str, id_expr: str, text_expr: str, query: str) -> str:
    """SELECT id, score for rows matching ``query`` (no order, no limit)."""
    clauses = parse_query(query)
    pos = [i for i, c in enumerate(clauses) if c.positive]
    neg = [i for i, c in enumerate(clauses) if not c.positive]
    counts = ", ".join(
        f"count(*) FILTER (WHERE {clause_test(c, 'term')}) AS tf{i}" for i, c in enumerate(clauses)
    )
    cond = " AND ".join([f"tf{i} > 0" for i in pos] + [f"tf{i} = 0" for i in neg])
    score = " + ".join(f"tf{i} / (tf{i} + 1.2)" for i in pos)
    return (
        f"WITH {terms_cte(table, id_expr, text_expr)}, "
        f"tf AS (SELECT id, {counts} FROM terms GROUP BY id) "
        f"SELECT id, round(({score}) / {float(len(pos))}, 6) AS score FROM tf WHERE {cond}"
    )


def headline_sql(words_table: str, query: str, width: int = 30, min_words: int = 10,
                 frags: int = 1, lead: int = 10) -> str:
    """SELECT id, snippet over ``words_table(id, text)`` - the cover rule of
    :func:`quarry.operators.search.with_headline_by` in relational DuckDB SQL:
    all runs between two highlighted words are compared."""
    terms = sorted({t for c in parse_query(query) if c.positive
                    for t in ([f"{c.terms[0]}*"] if c.kind == "prefix" else c.terms)})
    tests = ", ".join(
        f"CASE WHEN {f'starts_with(term, {chr(39)}{t[:-1]}{chr(39)})' if t.endswith('*') else f'term = {chr(39)}{t}{chr(39)}'} "
        f"THEN '{t}' END" for t in terms) or "CAST(NULL AS VARCHAR)"

    def start(c: str, lo: str, hi: str) -> str:
        return f"greatest({lo}, least({c}.i - least({lead}, {width} - ({c}.j - {c}.i + 1)), {hi} - {width}))"

    def text(s: str, end: str) -> str:
        return (f"(SELECT string_agg(CASE WHEN m.i IS NULL THEN x.w ELSE '<b>' || x.w || '</b>' END, ' ' ORDER BY x.i) "
                f"FROM x LEFT JOIN m ON m.id = x.id AND m.i = x.i WHERE x.id = one.id AND x.i >= {s} AND x.i < {end})")

    first = text("one.s", f"one.s + {width}")
    if frags >= 2:
        body = (f"CASE WHEN two.s IS NULL THEN {first} "
                f"WHEN two.s < one.s THEN {text('two.s', f'least(two.s + {width}, one.s)')} || ' ... ' || {first} "
                f"ELSE {first} || ' ... ' || {text('two.s', f'two.s + {width}')} END")
    else:
        body = first
    return f"""
    WITH w AS (SELECT id, regexp_extract_all(coalesce(text, ''), '\\S+') AS words FROM {words_table}),
    x AS (SELECT id, unnest(words) AS w, unnest(range(len(words))) AS i FROM w),
    tok AS (SELECT id, i, unnest(regexp_extract_all(lower(w), '{TOKEN_PATTERN}')) AS t FROM x),
    hit AS (SELECT DISTINCT id, i, hit FROM (
        SELECT id, i, unnest([{tests}]) AS hit FROM (
            SELECT id, i, {sql_stem('t')} AS term FROM tok WHERE t NOT IN ({sql_stop_list()}))) WHERE hit IS NOT NULL),
    m AS (SELECT DISTINCT id, i FROM hit),
    run AS (SELECT a.id, a.i, b.i AS j, count(DISTINCT hit.hit) AS k
        FROM m a JOIN m b ON a.id = b.id AND b.i >= a.i AND b.i < a.i + {width}
        JOIN hit ON hit.id = a.id AND hit.i >= a.i AND hit.i <= b.i GROUP BY 1, 2, 3),
    c1 AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY id ORDER BY k DESC, j - i, i) = 1),
    one AS (SELECT w.id, c1.i, c1.j, CASE WHEN c1.i IS NOT NULL THEN {start('c1', '0', 'len(w.words)')} END AS s,
        len(w.words) AS n, w.words FROM w LEFT JOIN c1 ON c1.id = w.id),
    c2 AS (SELECT run.*, one.s, one.n FROM run JOIN one ON one.id = run.id AND (run.j < one.s OR run.i >= one.s + {width})
        QUALIFY row_number() OVER (PARTITION BY run.id ORDER BY run.k DESC, run.j - run.i, run.i) = 1),
    two AS (SELECT id, CASE WHEN i < s THEN {start('c2', '0', 's')} ELSE {start('c2', f's + {width}', 'n')} END AS s FROM c2)
    SELECT one.id, CASE WHEN one.s IS NULL THEN array_to_string(list_slice(one.words, 1, {min_words}), ' ')
        ELSE {body} END AS snippet FROM one LEFT JOIN two ON two.id = one.id
    """


def phrase_sql(table: str, id_expr: str, text_expr: str, phrase: list[tuple[str, int]]) -> str:
    """SELECT id, n over ``table``: rows that hold the phrase, and how often it
    begins; ``phrase`` lists (term, tokens behind the first)."""
    joins = " ".join(
        f"JOIN terms t{k} ON t{k}.id = t0.id AND t{k}.pos = t0.pos + {behind} AND t{k}.term = '{term}'"
        for k, (term, behind) in enumerate(phrase[1:], 1))
    return (
        f"WITH toks AS (SELECT {id_expr} AS id, regexp_extract_all(lower(coalesce({text_expr}, '')), '{TOKEN_PATTERN}') AS ts FROM {table}), "
        f"tok AS (SELECT id, unnest(ts) AS t, unnest(range(len(ts))) AS pos FROM toks), "
        f"terms AS (SELECT id, pos, {sql_stem('t')} AS term FROM tok WHERE t NOT IN ({sql_stop_list()})) "
        f"SELECT t0.id, count(*) AS n FROM terms t0 {joins} WHERE t0.term = '{phrase[0][0]}' GROUP BY t0.id"
    )
