"""Full-text match, rank and headline over a text column.

Ad-hoc search is a *narrow* plan: the analysed term array of each row is
built once in a projection, every query clause is a ``size(filter(..))`` over
that array, and the match is a plain ``Filter``.  No explode, no shuffle;
the top-k is ``TakeOrderedAndProject``.  Repeated workloads should use the
inverted index of :mod:`quarry.operators.index` instead.

Query language (the reference's ``split(/\\s+/).join(' & ')`` plus the
operators that pass through it unescaped):

* ``word``      - required term (every analysed term of the token)
* ``!word``     - excluded term
* ``pre:*``     - required: some term starting with the analysed prefix
* ``a|b``       - required: any of the analysed alternatives
* ``a<->b``     - required phrase: ``b`` is the token behind ``a``; ``a<3>b``
  wants it three tokens behind; longer chains, prefixes and, as alternatives,
  ``a|b<->c`` too; ``!a<->b`` excludes the phrase

Stop words vanish, but keep their place in a phrase (``cat<->on<->mat`` wants
``mat`` two tokens behind ``cat``); a phrase left with one term is that term; a query without any positive clause matches nothing.
Rank: ``round(avg over positive clauses of tf / (tf + 1.2), 6)``, tf of a phrase
being the places where it begins.
"""

from __future__ import annotations

from dataclasses import dataclass

import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T

TERMS = "_terms"
PLACES = "_places"
K1 = 1.2
_LINK = regex.compile(r"<(-|\d{1,5})>")


@dataclass(frozen=True)
class Clause:
    kind: str  # "term" | "prefix" | "any" | "phrase" | "not"
    terms: tuple[str, ...]
    #: Alternative phrases, each (term, tokens behind the first term), ...; set
    #: where places matter.  Prefixes end in ``*``, as in ``terms``.
    phrases: tuple[tuple[tuple[str, int], ...], ...] = ()

    @property
    def positive(self) -> bool:
        return self.kind != "not"


def _alternatives(part: str) -> list[str]:
    """Analysed terms of one alternative; a prefix keeps a ``*`` at its end
    (analysed terms are letters and digits, so the mark is unambiguous)."""
    if part.endswith(":*"):
        return [t + "*" for t in T.py_analyze(part[:-2])]
    return T.py_analyze(part)


def _phrase(part: str) -> tuple[tuple[str, int], ...]:
    """(term, place) of a chain like ``a<->b<3>c*``, places counted from its
    first term.  A part of several tokens is a phrase by itself; stop words
    hold their place."""
    pieces = _LINK.split(part)
    found, at = [], 0
    for i in range(0, len(pieces), 2):
        if i:
            at += 1 if pieces[i - 1] == "-" else int(pieces[i - 1])
        prefix = pieces[i].endswith(":*")
        toks = T.py_tokens(pieces[i][:-2] if prefix else pieces[i])
        for k, tok in enumerate(toks):
            if not T.py_is_stop_word(tok):
                found.append((T.py_stem(tok) + "*" * prefix, at + k))
        at += max(len(toks) - 1, 0)
    return tuple((t, p - found[0][1]) for t, p in found)


def _alternation(tok: str) -> Clause | None:
    """Clause of ``a|b<->c``: any of its words or phrases."""
    if not _LINK.search(tok):
        alts = tuple(dict.fromkeys(t for part in tok.split("|") for t in _alternatives(part)))
        return Clause("any", alts) if alts else None
    phrases = tuple(dict.fromkeys(p for p in map(_phrase, tok.split("|")) if p))
    terms = tuple(dict.fromkeys(t for p in phrases for t, _ in p))
    if not phrases:
        return None
    if all(len(p) == 1 for p in phrases):
        return Clause("any", terms)
    return Clause("phrase", terms, phrases)


def parse_query(query: str | None) -> list[Clause]:
    clauses: list[Clause] = []
    for tok in T.split_query(query):
        if tok.startswith("!"):
            # !(a|b) excludes each alternative
            if _LINK.search(tok):
                c = _alternation(tok[1:])
                clauses += [Clause("not", tuple(t for t, _ in p), (p,) if len(p) > 1 else ())
                            for p in (c.phrases or [((t, 0),) for t in c.terms] if c else ())]
                continue
            for t in dict.fromkeys(t for part in tok[1:].split("|") for t in _alternatives(part)):
                clauses.append(Clause("not", (t,)))
        elif "|" in tok or _LINK.search(tok):
            c = _alternation(tok)
            if c:
                single = c.kind == "any" and len(c.terms) == 1 and "|" not in tok and not c.terms[0].endswith("*")
                clauses.append(Clause("term", c.terms) if single else c)
        elif tok.endswith(":*"):
            for t in T.py_analyze(tok[:-2]):
                clauses.append(Clause("prefix", (t,)))
        else:
            for t in T.py_analyze(tok):
                clauses.append(Clause("term", (t,)))
    # identical clauses count once
    return list(dict.fromkeys(clauses))


def split_terms(c: Clause) -> tuple[list[str], list[str]]:
    """(exact terms, prefixes) of a clause."""
    if c.kind == "prefix":
        return [], list(c.terms)
    return [t for t in c.terms if not t.endswith("*")], [t[:-1] for t in c.terms if t.endswith("*")]


def term_test(c: Clause, x: Column) -> Column:
    """Whether term ``x`` satisfies the clause (for "not": is excluded by it)."""
    exact, prefixes = split_terms(c)
    out = x.isin(*exact) if exact else F.lit(False)
    for p in prefixes:
        out = out | x.startswith(p)
    return out


def candidate_pattern(clauses: list[Clause]) -> str:
    """Regex selecting every token that *could* analyse to a clause term.

    The stemmer only drops a word's tail and may then add one ``y`` or ``e``,
    so a token whose analysed form equals - or starts
    with - ``t`` must itself start with ``t[:-1]`` (``t`` for one-letter
    terms).  Terms are letter/digit runs, so they need no escaping.  The
    exact analysis then runs on these few tokens only.
    """
    heads = set()
    for c in clauses:
        for t in (t.rstrip("*") for t in c.terms):
            heads.add(t[:-1] if len(t) > 1 else t)
    alts = "|".join(sorted(heads))
    return rf"(?<![\p{{L}}\p{{N}}])(?:{alts})[\p{{L}}\p{{N}}]*"


def candidate_terms_sql(text_sql: str, clauses: list[Clause]) -> str:
    """Spark SQL: analysed terms of the candidate tokens of ``text_sql``."""
    toks = (f"regexp_extract_all(lower(coalesce({text_sql}, '')), "
            f"r'{candidate_pattern(clauses)}', 0)")
    return T.spark_sql_analyze(toks)


def _test_sql(terms, x: str) -> str:
    exact = [t for t in terms if not t.endswith("*")]
    tests = [f"startswith({x}, {T.spark_sql_literal(t[:-1])})" for t in terms if t.endswith("*")]
    if exact:
        tests.append(f"{x} IN ({', '.join(T.spark_sql_literal(t) for t in exact)})")
    return " OR ".join(tests)


def phrase_starts_sql(phrase, places_of) -> str:
    """Spark SQL: places where the phrase begins: the place arrays of its
    terms (``places_of(term)``), shifted and intersected."""
    out = None
    for term, behind in phrase:
        shifted = f"transform({places_of(term)}, p -> p - {behind})"
        out = shifted if out is None else f"array_intersect({out}, {shifted})"
    return out


def _count_sql(c: Clause) -> str:
    """Spark SQL: how often the clause's term or phrases occur in a row with
    ``TERMS`` and, for phrases, ``PLACES``."""
    if c.phrases:
        def places(t):
            return f"transform(filter({PLACES}, x -> {_test_sql([t], 'x.t')}), x -> x.i)"

        return "(" + " + ".join(f"size({phrase_starts_sql(p, places)})" for p in c.phrases) + ")"
    exact, prefixes = split_terms(c)
    return f"size(filter({TERMS}, x -> {_test_sql([*exact, *(p + '*' for p in prefixes)], 'x')}))"


def _analysed(df: DataFrame, text_col: str, clauses: list[Clause]) -> tuple[DataFrame, list[Column]]:
    """``df`` with the analysed candidate terms, and each clause's count.

    Places are worked out only where a query has phrases, and there only in
    rows that hold all terms of one of them."""
    staged = df.withColumn(TERMS, F.expr(candidate_terms_sql(f"`{text_col}`", clauses)))
    phrases = [p for c in clauses for p in c.phrases]
    if phrases:
        heads = candidate_pattern([c for c in clauses if c.phrases]).split(")", 1)[1]
        toks = f"regexp_extract_all(lower(coalesce(`{text_col}`, '')), r'{T.TOKEN_PATTERN}', 0)"
        near = (f"filter(transform({toks}, (t, i) -> named_struct('t', t, 'i', i)), "
                f"x -> x.t RLIKE r'^{heads}$' AND NOT {T.spark_sql_is_stop_word('x.t')})")
        held = " OR ".join("(" + " AND ".join(f"exists({TERMS}, x -> {_test_sql([t], 'x')})" for t, _ in p) + ")" for p in phrases)
        staged = staged.withColumn(PLACES, F.expr(
            f"CASE WHEN {held} THEN transform({near}, x -> named_struct('t', {T.spark_sql_stem('x.t')}, 'i', x.i)) "
            "ELSE CAST(array() AS array<struct<t: string, i: int>>) END"))
    return staged, [F.expr(_count_sql(c)) for c in clauses]


def term_hits(clauses: list[Clause], x: Column) -> Column:
    """True when analysed term ``x`` satisfies some positive clause."""
    tests = [term_test(c, x) for c in clauses if c.positive]
    if not tests:
        return F.lit(False)
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def _match_and_score(clauses: list[Clause], tf) -> tuple[Column, Column]:
    """(match condition, score) from ``tf(i)`` -> Column of clause i's count."""
    pos = [i for i, c in enumerate(clauses) if c.positive]
    neg = [i for i, c in enumerate(clauses) if not c.positive]
    cond = F.lit(True)
    for i in pos:
        cond = cond & (tf(i) > 0)
    for i in neg:
        cond = cond & (tf(i) == 0)
    sat = [tf(i) / (tf(i) + F.lit(K1)) for i in pos]
    total = sat[0]
    for s in sat[1:]:
        total = total + s
    return cond, F.round(total / F.lit(float(len(pos))), 6)


def fts_match(df: DataFrame, text_col: str, query: str | None) -> DataFrame:
    """Rows whose text satisfies every clause, with a ``score`` column added.

    Plan: one projection analyses the text; a flat-map (``inline`` of a
    zero-or-one element array) keeps the matching rows with their clause
    counts.  Expressing the match inside the generator instead of a
    ``Filter`` keeps Catalyst from pushing the predicate below the analysis
    and re-deriving the term array once per clause.
    """
    clauses = parse_query(query)
    if not any(c.positive for c in clauses):
        return df.withColumn("score", F.lit(None).cast("double")).limit(0)
    staged, counts = _analysed(df, text_col, clauses)
    row = F.struct(
        *[F.col(c) for c in df.columns],
        *[n.alias(f"_tf{i}") for i, n in enumerate(counts)],
    )
    cond, _ = _match_and_score(clauses, lambda i: F.lit(0))
    kept = staged.select(
        F.inline(F.filter(F.array(row), lambda r: _match_and_score(clauses, lambda i: r[f"_tf{i}"])[0]))
    )
    _, score = _match_and_score(clauses, lambda i: F.col(f"_tf{i}"))
    return kept.select(*[F.col(c) for c in df.columns], score.alias("score"))


def fts_match_many(df: DataFrame, text_col: str, queries: list[str]) -> DataFrame:
    """Matches of many queries in ONE pass over the text: ``query`` and
    ``score`` columns added, one row per (row, matching query).

    The candidate tokens of all queries are extracted and analysed once per
    row; each distinct clause is counted once; the per-query match is a
    flat-map over the queries (no join, no shuffle)."""
    parsed = {q: parse_query(q) for q in queries}
    parsed = {q: cl for q, cl in parsed.items() if any(c.positive for c in cl)}
    if not parsed:
        return df.select("*", F.lit(None).cast("string").alias("query"),
                         F.lit(None).cast("double").alias("score")).limit(0)
    clauses = list(dict.fromkeys(c for cl in parsed.values() for c in cl))
    idx = {c: i for i, c in enumerate(clauses)}
    staged, counts = _analysed(df, text_col, clauses)
    counted = staged.select(
        *[F.col(c) for c in df.columns],
        *[n.alias(f"_c{i}") for i, n in enumerate(counts)],
    )
    per_query = []
    for q, cl in parsed.items():
        cond, score = _match_and_score(cl, lambda i, cl=cl: F.col(f"_c{idx[cl[i]]}"))
        per_query.append(F.struct(F.lit(q).alias("query"), score.alias("score"), cond.alias("_ok")))
    hits = counted.select(*[F.col(c) for c in df.columns],
                          F.inline(F.filter(F.array(*per_query), lambda x: x["_ok"])))
    return hits.drop("_ok")


def top_k_per_query(hits: DataFrame, order: list[Column], limit: int, offset: int = 0,
                    group: str = "query") -> DataFrame:
    """Rows ``offset < rank <= offset + limit`` per group, ``_pos`` = rank -
    offset.  ``row_number() <= n`` lets Spark insert a partial
    WindowGroupLimit before the shuffle (map-side top-k), so a hot group never
    travels whole."""
    w = Window.partitionBy(group).orderBy(*order)
    ranked = hits.withColumn("_rank", F.row_number().over(w))
    kept = ranked.filter((F.col("_rank") <= offset + limit) & (F.col("_rank") > offset))
    return kept.withColumn("_pos", F.col("_rank") - offset).drop("_rank")


def fts_rank(
    df: DataFrame,
    id_col: str,
    text_col: str,
    query: str | None,
    limit: int = 20,
    offset: int = 0,
) -> DataFrame:
    """Top-``limit`` after ``offset`` by score desc, id asc."""
    hits = fts_match(df, text_col, query)
    ordered = hits.orderBy(F.col("score").desc(), F.col(id_col).asc_nulls_last())
    if offset:
        ordered = ordered.offset(offset)
    return ordered.limit(limit)


def headline_spec(query: str | None) -> Column:
    """Literal struct describing what a headline highlights for ``query``:
    exact terms, prefixes, and the candidate-token regex."""
    clauses = [c for c in parse_query(query) if c.positive]
    exact = sorted({t for c in clauses if c.positive for t in split_terms(c)[0]})
    prefix = sorted({t for c in clauses if c.positive for t in split_terms(c)[1]})
    arr = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    return F.struct(arr(exact).alias("exact"), arr(prefix).alias("prefix"),
                    F.lit(candidate_pattern(clauses) if clauses else "(?!)").alias("pattern"))


def with_headline(
    df: DataFrame,
    text_col: str,
    query: str | None,
    out_col: str = "snippet",
    max_words: int = 30,
    min_words: int = 10,
    max_fragments: int = 1,
    lead: int = 10,
) -> DataFrame:
    """Add a ``ts_headline`` analogue (X5) for one query as ``out_col``."""
    return with_headline_by(df, text_col, headline_spec(query), out_col, max_words, min_words,
                            max_fragments, lead)


def with_headline_by(
    df: DataFrame,
    text_col: str,
    spec: Column,
    out_col: str = "snippet",
    max_words: int = 30,
    min_words: int = 10,
    max_fragments: int = 1,
    lead: int = 10,
) -> DataFrame:
    """Headline (X5) where ``spec`` (see :func:`headline_spec`) may differ per
    row - e.g. ``map_of_specs[query]`` for a batch of queries - so one
    projection serves every query.

    Words are whitespace runs.  A word is highlighted (``<b>w</b>``) when one
    of its analysed terms satisfies a positive clause; the terms and prefixes
    of the query that it satisfies are its hits.

    A cover is a run of at most ``max_words`` words that begins and ends with
    a highlighted word.  The best has the most different hits, then the fewest
    words, then stands first.  Its fragment is the ``max_words`` words from up
    to ``lead`` words before it - fewer if it would not fit otherwise, or where
    the text ends.  With ``max_fragments=2`` the best cover of the words before
    or behind the first fragment gives a second one that keeps to its side;
    both stand in text order, joined with `` ... ``.  No match -> the first
    ``min_words`` words, unhighlighted.

    The hits of the words are materialised in their own projection (referenced
    several times, so Catalyst keeps it instead of re-deriving it per use);
    only a word's candidate tokens are analysed.  Covers are found by a window
    over the highlighted words alone, ``max_words`` at most for each.  Apply it
    to final (top-k) rows: it is per-word work.
    """
    staged = df.withColumn("_hl_spec", spec)
    staged = staged.withColumn("_hl_w", F.expr(f"regexp_extract_all(coalesce(`{text_col}`, ''), r'{T.WORD_PATTERN}', 0)"))
    terms = T.spark_sql_analyze("regexp_extract_all(lower(w), _hl_spec.pattern, 0)")
    hits = ("filter(transform(_hl_w, (w, i) -> named_struct('i', i, 'h', _hl_hits(w))), e -> size(e.h) > 0)")
    own = (f"array_distinct(flatten(transform({terms}, s -> concat(filter(_hl_spec.exact, x -> x = s), "
           "transform(filter(_hl_spec.prefix, p -> startswith(s, p)), p -> concat(p, '*'))))))")
    staged = staged.withColumn("_hl_m", F.expr(hits.replace("_hl_hits(w)", own)))
    staged = staged.withColumn("_hl_a", F.expr(f"struct({_best_cover_sql('_hl_m', max_words, '0', 'size(_hl_w)')} AS c, "
                                               "size(_hl_w) AS n)"))
    staged = staged.withColumn("_hl_s1", F.expr(_start_sql("_hl_a.c", max_words, lead, "0", "_hl_a.n")))
    cut = lambda lo, n: (
        f"array_join(transform(slice(_hl_w, {lo} + 1, {n}), (w, i) -> CASE WHEN exists(_hl_m, e -> e.i = i + {lo}) "
        "THEN concat('<b>', w, '</b>') ELSE w END), ' ')")
    first = cut("_hl_s1", max_words)
    if max_fragments >= 2:
        end = f"(_hl_s1 + {max_words})"
        before, behind = _best_cover_sql("_hl_m", max_words, "0", "_hl_s1"), _best_cover_sql("_hl_m", max_words, end, "_hl_a.n")
        staged = staged.withColumn("_hl_b", F.expr(f"struct({before} AS l, {behind} AS r)"))
        left = "(_hl_b.r IS NULL OR _hl_b.l <= _hl_b.r)"
        staged = staged.withColumn("_hl_s2", F.expr(
            f"CASE WHEN _hl_b.l IS NOT NULL AND {left} THEN {_start_sql('_hl_b.l', max_words, lead, '0', '_hl_s1')} "
            f"WHEN _hl_b.r IS NOT NULL THEN {_start_sql('_hl_b.r', max_words, lead, end, '_hl_a.n')} END"))
        body = (f"CASE WHEN _hl_s2 IS NULL THEN {first} "
                f"WHEN _hl_s2 < _hl_s1 THEN concat({cut('_hl_s2', f'least({max_words}, _hl_s1 - _hl_s2)')}, ' ... ', {first}) "
                f"ELSE concat({first}, ' ... ', {cut('_hl_s2', max_words)}) END")
    else:
        body = first
    plain = f"array_join(slice(_hl_w, 1, {min_words}), ' ')"
    out = staged.withColumn(out_col, F.expr(f"CASE WHEN _hl_a.c IS NULL THEN {plain} ELSE {body} END"))
    return out.drop("_hl_spec", "_hl_w", "_hl_m", "_hl_a", "_hl_s1", "_hl_b", "_hl_s2")


def _best_cover_sql(m: str, width: int, lo: str, hi: str) -> str:
    """Spark SQL: the best cover of words ``lo`` .. ``hi`` - 1 among the
    highlighted words ``m`` = array<struct<i, h>> (word, hits), as
    struct<less, size, i>; NULL without a highlighted word.  ``less`` falls
    with the number of different hits, so the smallest struct is the best."""
    inside = f"filter({m}, e -> e.i >= {lo} AND e.i < {hi})"
    near = f"filter(slice(e.r, e.k + 1, {width}), x -> x.i < e.r[e.k].i + {width})"
    # of each hit the first word that has it; the cover ends at the last of these
    ends = (f"transform(array_distinct(flatten(transform(e.w, x -> x.h))), "
            "h -> array_min(transform(filter(e.w, x -> array_contains(x.h, h)), x -> x.i)))")
    steps = f"transform(array({inside}), r -> transform(sequence(1, size(r)), k -> named_struct('r', r, 'k', k - 1)))[0]"
    windows = f"transform({steps}, e -> named_struct('w', {near}, 'i', e.r[e.k].i))"
    scored = (f"transform(transform({windows}, e -> named_struct('x', {ends}, 'i', e.i)), "
              "e -> named_struct('less', -size(e.x), 'size', array_max(e.x) - e.i + 1, 'i', e.i))")
    return f"(CASE WHEN size({inside}) > 0 THEN array_min({scored}) END)"


def _start_sql(c: str, width: int, lead: int, lo: str, hi: str) -> str:
    """Spark SQL: where the fragment of cover ``c`` begins in ``lo`` .. ``hi``."""
    return f"greatest({lo}, least({c}.i - least({lead}, {width} - {c}.size), {hi} - {width}))"
