"""Text analysis as Catalyst expressions.

The reference names PostgreSQL's ``english`` text-search configuration and
nothing more, so the analysis contract is ours and is frozen here, once, so
that every search operator and every DuckDB oracle agree on it:

* tokens  = maximal runs of Unicode letters/digits of the lower-cased text;
* stop words (Spark's default English list) are removed;
* the remaining tokens go through a light English stemmer, the plural rules of
  the "S-stemmer" (Harman 1991) with those for ``-ing``, ``-ed``, ``-ly`` and a
  final ``e``.  The first rule whose suffix matches decides:
  ``ies -> y`` unless ``eies``/``aies``; ``ied -> y`` from five letters on;
  ``es`` goes from six letters on, else ``es -> e``, unless
  ``aes``/``ees``/``oes``; ``ings`` is stripped; ``s`` goes unless
  ``us``/``ss``; ``ing`` is stripped; ``eed`` stays; ``ed`` is stripped; ``ly``
  goes after one of ``cdeghkmnrt``, from five letters on; ``e`` goes from five
  letters on unless ``ee``.
  *Stripped* needs three letters before the suffix and a vowel among them;
  a doubled consonant then loses one letter (``running``: ``run``) if four or
  more letters are left, and a short syllable gets its ``e`` back (``hoping``:
  ``hope``).

Everything here returns a ``Column``: analysis runs inside the executors'
projections, never in Python.
"""

from __future__ import annotations

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's default English stop-word list
# (pyspark.ml.feature.StopWordsRemover.loadDefaultStopWords("english")),
# in its natural order.
STOP_WORDS: tuple[str, ...] = tuple(
    """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be been
being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before
after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now
i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm
you're he's she's it's we're they're i've we've you've they've isn't aren't
wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
there's what's when's where's who's why's would
""".split()
)

# Java regex (Spark) and RE2 (DuckDB) read this class the same way.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
WORD_PATTERN = r"\S+"

_STOP_SET = frozenset(STOP_WORDS)
_PY_TOKEN = regex.compile(TOKEN_PATTERN)


def tokens(text: Column) -> Column:
    """array<string> of lower-cased letter/digit runs; NULL text -> []."""
    return F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), 0
    )


# Fixed values of the stemmer.
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
VOWEL = "[aeiouy]"
SHORT_SYLLABLE = "^[^aeiouy]*[aeiouy][^aeiouywx]$"
BEFORE_LY = "[cdeghkmnrt]ly$"


def stem(word: Column) -> Column:
    """The stemmer on one lower-case token (see module docstring)."""
    n = F.length(word)

    def ends(*suffixes: str) -> Column:
        out = word.endswith(suffixes[0])
        for x in suffixes[1:]:
            out = out | word.endswith(x)
        return out

    def less(k: int) -> Column:
        return F.substring(word, F.lit(1), n - k)

    def stripped(k: int) -> Column:
        rest = less(k)
        return (F.when((n < k + 3) | ~rest.rlike(VOWEL), word)
                .when((n >= k + 4) & F.right(rest, F.lit(2)).isin(*DOUBLES), less(k + 1))
                .when(rest.rlike(SHORT_SYLLABLE), F.concat(rest, F.lit("e")))
                .otherwise(rest))

    # by the last letter first, so that most words are through after five tests
    return (
        F.when(ends("s"),
               F.when(ends("ies"), F.when(ends("eies", "aies") | (n <= 3), word).otherwise(F.concat(less(3), F.lit("y"))))
               .when(ends("es"), F.when(ends("aes", "ees", "oes") | (n <= 2), word).when(n >= 6, less(2)).otherwise(less(1)))
               .when(ends("ings"), stripped(4))
               .otherwise(F.when(ends("us", "ss") | (n <= 1), word).otherwise(less(1))))
        .when(ends("d"),
              F.when(ends("ied"), F.when(n <= 4, word).otherwise(F.concat(less(3), F.lit("y"))))
              .when(ends("eed"), word)
              .when(ends("ed"), stripped(2))
              .otherwise(word))
        .when(ends("ing"), stripped(3))
        .when(ends("ly"), F.when((n >= 5) & word.rlike(BEFORE_LY), less(2)).otherwise(word))
        .when(ends("e"), F.when((n >= 5) & ~ends("ee"), less(1)).otherwise(word))
        .otherwise(word)
    )


def is_stop_word(token: Column) -> Column:
    """Stop-word test for streams of tokens (e.g. after ``explode``): a literal
    IN list of this size becomes a hash-set lookup (OptimizeIn)."""
    return token.isin(*STOP_WORDS)


def analyze(text: Column) -> Column:
    """array<string> of analysed terms, in text order, duplicates kept."""
    return F.transform(
        F.filter(tokens(text), lambda t: ~is_stop_word(t)), lambda t: stem(t)
    )


def null_safe_concat(*cols: Column) -> Column:
    """``coalesce(a,'') || ' ' || coalesce(b,'')`` - keeps the separator
    even when a side is NULL (``concat_ws`` would drop it)."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(" "))
        parts.append(F.coalesce(c, F.lit("")))
    return F.concat(*parts)


# ---------------------------------------------------------------------------
# Driver-side helpers for *literal* query strings.  The query is a parameter
# (a handful of words), so analysing it in Python is a small helper; it follows
# exactly the Column rules above.


def _py_stripped(w: str, k: int) -> str:
    rest = w[:-k]
    if len(rest) < 3 or not regex.search(VOWEL, rest):
        return w
    if len(rest) >= 4 and rest.endswith(DOUBLES):
        return rest[:-1]
    return rest + "e" if regex.search(SHORT_SYLLABLE, rest) else rest


def py_stem(w: str) -> str:
    n = len(w)
    if w.endswith("ies"):
        return w if w.endswith(("eies", "aies")) or n <= 3 else w[:-3] + "y"
    if w.endswith("ied"):
        return w if n <= 4 else w[:-3] + "y"
    if w.endswith("es"):
        if w.endswith(("aes", "ees", "oes")) or n <= 2:
            return w
        return w[:-2] if n >= 6 else w[:-1]
    if w.endswith("ings"):
        return _py_stripped(w, 4)
    if w.endswith("s"):
        return w if w.endswith(("us", "ss")) or n <= 1 else w[:-1]
    if w.endswith("ing"):
        return _py_stripped(w, 3)
    if w.endswith("eed"):
        return w
    if w.endswith("ed"):
        return _py_stripped(w, 2)
    if w.endswith("ly"):
        return w[:-2] if n >= 5 and regex.search(BEFORE_LY, w) else w
    if w.endswith("e"):
        return w[:-1] if n >= 5 and not w.endswith("ee") else w
    return w


def py_tokens(text: str) -> list[str]:
    return _PY_TOKEN.findall(text.lower())


def py_is_stop_word(token: str) -> bool:
    return token in _STOP_SET


def py_analyze(text: str) -> list[str]:
    return [py_stem(t) for t in py_tokens(text) if t not in _STOP_SET]


def split_query(query: str | None) -> list[str]:
    """Whitespace split, empties dropped (the reference's ``split(/\\s+/)``)."""
    return [t for t in regex.split(r"\s+", query or "") if t]


def sql_string_list(values) -> str:
    """Render values as a SQL list of string literals (for oracle SQL)."""
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def sql_stem(w: str) -> str:
    """The stemmer in DuckDB SQL over SQL expression ``w``: the rules as
    regular expressions with the letters they need, longest suffix first."""
    doubled = "|".join(DOUBLES)

    def stripped(suffix: str) -> str:
        rest = f"regexp_replace({w}, '{suffix}$', '')"
        return (f"WHEN regexp_matches({w}, '{suffix}$') THEN "
                f"(CASE WHEN NOT regexp_matches({rest}, '...$') OR NOT regexp_matches({rest}, '{VOWEL}') THEN {w} "
                f"WHEN regexp_matches({rest}, '..({doubled})$') THEN left({rest}, -1) "
                f"WHEN regexp_matches({rest}, '{SHORT_SYLLABLE}') THEN {rest} || 'e' ELSE {rest} END) ")

    return (
        f"CASE WHEN regexp_matches({w}, '(e|a)ies$|^ies$') THEN {w} "
        f"WHEN regexp_matches({w}, 'ies$') THEN regexp_replace({w}, 'ies$', 'y') "
        f"WHEN regexp_matches({w}, '..ied$') THEN regexp_replace({w}, 'ied$', 'y') "
        f"WHEN regexp_matches({w}, 'ied$|[aeo]es$|^es$') THEN {w} "
        f"WHEN regexp_matches({w}, '....es$') THEN left({w}, -2) "
        f"WHEN regexp_matches({w}, 'es$') THEN left({w}, -1) "
        f"{stripped('ings')}"
        f"WHEN regexp_matches({w}, '(u|s)s$|^s$') THEN {w} "
        f"WHEN regexp_matches({w}, 's$') THEN left({w}, -1) "
        f"{stripped('ing')}"
        f"WHEN regexp_matches({w}, 'eed$') THEN {w} "
        f"{stripped('ed')}"
        f"WHEN regexp_matches({w}, '..{BEFORE_LY}') THEN left({w}, -2) "
        f"WHEN regexp_matches({w}, '....e$') AND NOT regexp_matches({w}, 'ee$') THEN left({w}, -1) "
        f"ELSE {w} END"
    )


def sql_stop_list() -> str:
    return sql_string_list(STOP_WORDS)


# ---------------------------------------------------------------------------
# The same contract as single Spark SQL expressions.  Inside higher-order
# functions these are built with one ``F.expr`` call instead of hundreds of
# Column calls; the stop-word ``IN`` list still becomes a hash-set lookup.


def spark_sql_literal(s: str) -> str:
    """A Spark SQL string literal (backslash escapes)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spark_sql_stem(w: str) -> str:
    """The stemmer as a Spark SQL expression over SQL expression ``w``."""
    n = f"length({w})"

    def ends(*suffixes: str) -> str:
        return "(" + " OR ".join(f"endswith({w}, '{x}')" for x in suffixes) + ")"

    def less(k: int) -> str:
        return f"substring({w}, 1, {n} - {k})"

    def stripped(k: int) -> str:
        return (f"(CASE WHEN {n} < {k + 3} OR NOT {less(k)} RLIKE '{VOWEL}' THEN {w} "
                f"WHEN {n} >= {k + 4} AND right({less(k)}, 2) IN ({sql_string_list(DOUBLES)}) THEN {less(k + 1)} "
                f"WHEN {less(k)} RLIKE '{SHORT_SYLLABLE}' THEN concat({less(k)}, 'e') ELSE {less(k)} END)")

    return (
        f"CASE WHEN {ends('ies')} THEN (CASE WHEN {ends('eies', 'aies')} OR {n} <= 3 THEN {w} "
        f"ELSE concat({less(3)}, 'y') END) "
        f"WHEN {ends('ied')} THEN (CASE WHEN {n} <= 4 THEN {w} ELSE concat({less(3)}, 'y') END) "
        f"WHEN {ends('es')} THEN (CASE WHEN {ends('aes', 'ees', 'oes')} OR {n} <= 2 THEN {w} "
        f"WHEN {n} >= 6 THEN {less(2)} ELSE {less(1)} END) "
        f"WHEN {ends('ings')} THEN {stripped(4)} "
        f"WHEN {ends('s')} THEN (CASE WHEN {ends('us', 'ss')} OR {n} <= 1 THEN {w} ELSE {less(1)} END) "
        f"WHEN {ends('ing')} THEN {stripped(3)} "
        f"WHEN {ends('eed')} THEN {w} "
        f"WHEN {ends('ed')} THEN {stripped(2)} "
        f"WHEN {ends('ly')} THEN (CASE WHEN {n} >= 5 AND {w} RLIKE '{BEFORE_LY}' THEN {less(2)} ELSE {w} END) "
        f"WHEN {ends('e')} THEN (CASE WHEN {n} >= 5 AND NOT {ends('ee')} THEN {less(1)} ELSE {w} END) "
        f"ELSE {w} END"
    )


def spark_sql_is_stop_word(t: str) -> str:
    return f"{t} IN ({', '.join(spark_sql_literal(w) for w in STOP_WORDS)})"


def spark_sql_analyze(tokens_sql: str, var: str = "t") -> str:
    """Analysed terms of the token array ``tokens_sql`` (stop words dropped,
    stemmed), as a Spark SQL expression."""
    return (f"transform(filter({tokens_sql}, {var} -> NOT {spark_sql_is_stop_word(var)}), "
            f"{var} -> {spark_sql_stem(var)})")
