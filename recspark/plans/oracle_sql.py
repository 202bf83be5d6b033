"""DuckDB SQL twins of the Spark operators (the correctness oracle).

The text measures are written with DuckDB list lambdas so that they follow the very
same definitions as ``functions/text.py`` (split pieces, token windows, left folds in
array order).  The feature pipeline is a CTE chain mirroring ``operators/features.py``.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from ..functions.text import LETTER_RX, NONLETTER_RX, SENTENCE_RX, TOKEN_RX, VOWEL_GROUP_RX
from ..functions.timefn import TIME_TO_POST
from ..functions.topics import topic_sql
from ..operators.features import COMMENT_POSITION
from ..operators.textops import TEST_AMPLIFIERS, TEST_DEAMPLIFIERS, TEST_LEXICON, TEST_NEGATORS

_ids = itertools.count()


def _v(prefix: str) -> str:
    return f"{prefix}{next(_ids)}"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(words: Sequence[str]) -> str:
    return "(" + ", ".join(q(w) for w in sorted(words)) + ")"


def fold(list_sql: str) -> str:
    """Left fold from 0.0 in list order (Spark ``aggregate``); 0.0 for empty lists."""
    a, b = _v("a"), _v("b")
    return f"list_reduce(list_prepend(0.0::DOUBLE, {list_sql}), lambda {a}, {b}: {a} + {b})"


def tokens(x: str) -> str:
    t = _v("t")
    return f"list_filter(string_split_regex(lower({x}), {q(TOKEN_RX)}), lambda {t}: {t} <> '')"


def sentences(x: str) -> str:
    s = _v("s")
    return f"list_filter(string_split_regex({x}, {q(SENTENCE_RX)}), lambda {s}: regexp_matches({s}, {q(LETTER_RX)}))"


def readability(x: str) -> dict[str, str]:
    t = _v("t")
    words = f"len({tokens(x)})"
    sents = f"len({sentences(x)})"
    letters = f"length(regexp_replace({x}, {q(NONLETTER_RX)}, '', 'g'))"
    syl = (f"list_sum(list_transform({tokens(x)}, lambda {t}: "
           f"greatest(1, len(regexp_extract_all({t}, {q(VOWEL_GROUP_RX)})))))")
    fk = (f"CASE WHEN {words} > 0 THEN 0.39::DOUBLE * ({words}::DOUBLE / {sents}::DOUBLE) "
          f"+ 11.8::DOUBLE * ({syl}::DOUBLE / {words}::DOUBLE) - 15.59::DOUBLE END")
    cl = (f"CASE WHEN {words} > 0 THEN 5.88::DOUBLE * ({letters}::DOUBLE / {words}::DOUBLE) "
          f"- 29.6::DOUBLE * ({sents}::DOUBLE / {words}::DOUBLE) - 15.8::DOUBLE END")
    return {"readFR": f"(round_even({fk}, 0) + 0.0)", "readCL": f"(round_even({cl}, 0) + 0.0)"}


def _polarity(t: str, lexicon: Mapping[str, float]) -> str:
    by_value: dict[float, list[str]] = {}
    for w, v in lexicon.items():
        by_value.setdefault(float(v), []).append(w)
    parts = [f"WHEN {t} IN {in_list(ws)} THEN {v!r}::DOUBLE" for v, ws in sorted(by_value.items())]
    return "CASE " + " ".join(parts) + " ELSE 0.0::DOUBLE END"


def _count_in(win: str, words: Sequence[str]) -> str:
    if not words:
        return "0"
    w = _v("w")
    return f"len(list_filter({win}, lambda {w}: {w} IN {in_list(words)}))"


def _is_in(t: str, words: Sequence[str]) -> str:
    return f"(CASE WHEN {t} IN {in_list(words)} THEN 1 ELSE 0 END)" if words else "0"


def sentiment(x: str, lexicon: Mapping[str, float] = TEST_LEXICON,
              negators: Sequence[str] = TEST_NEGATORS, amplifiers: Sequence[str] = TEST_AMPLIFIERS,
              deamplifiers: Sequence[str] = TEST_DEAMPLIFIERS, before: int = 5, after: int = 2,
              amp_weight: float = 0.8) -> str:
    s, cl, c, t, i = _v("s"), _v("cl"), _v("c"), _v("t"), _v("i")
    n = f"len({c})"
    lo = f"greatest(1, {i} - {before})"
    hi = f"least({n}, {i} + {after})"
    win = f"list_slice({c}, {lo}, {hi})"
    neg = f"({_count_in(win, negators)} - {_is_in(t, negators)})"
    amp = f"({_count_in(win, amplifiers)} - {_is_in(t, amplifiers)})"
    deamp = f"({_count_in(win, deamplifiers)} - {_is_in(t, deamplifiers)})"
    sign = f"(CASE WHEN {neg} % 2 = 1 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END)"
    p = _polarity(t, lexicon)
    contrib = (f"CASE WHEN ({p}) = 0.0 THEN 0.0::DOUBLE ELSE ({p}) * {sign} * "
               f"greatest(0.0::DOUBLE, 1.0::DOUBLE + {amp_weight!r}::DOUBLE * ({amp} * {sign} - {deamp})) END")
    clause_score = fold(f"list_transform({c}, lambda {t}, {i}: {contrib})")
    clauses = f"list_transform(string_split({s}, ','), lambda {cl}: {tokens(cl)})"
    c2 = _v("c")
    words = f"list_sum(list_transform({clauses}, lambda {c2}: len({c2})))"
    sent_score = f"({fold(f'list_transform({clauses}, lambda {c}: {clause_score})')} / sqrt({words}::DOUBLE))"
    return f"(CASE WHEN {x} IS NULL THEN NULL ELSE {fold(f'list_transform({sentences(x)}, lambda {s}: {sent_score})')} END)"


def sentiment_bucket(x: str) -> str:
    return (f"CASE WHEN {x} <= -0.5 THEN 'Very Negative' "
            f"WHEN {x} > -0.5 AND {x} <= -0.1 THEN 'Negative' "
            f"WHEN {x} > -0.1 AND {x} < 0.1 THEN 'Neutral' "
            f"WHEN {x} >= 0.1 AND {x} < 0.5 THEN 'Positive' "
            f"WHEN {x} >= 0.5 THEN 'Very Positive' END")


def time_of_day(h: str) -> str:
    return (f"CASE WHEN {h} >= 8 AND {h} < 12 THEN 'Morning' WHEN {h} >= 12 AND {h} < 18 THEN 'Afternoon' "
            f"WHEN {h} >= 18 AND {h} < 24 THEN 'Evening' WHEN {h} >= 0 AND {h} < 8 THEN 'Late Night' END")


def ttp_category(t: str) -> str:
    c = TIME_TO_POST
    return (f"CASE WHEN {t} >= 0 AND {t} < 15 THEN {q(c[0])} WHEN {t} >= 15 AND {t} < 30 THEN {q(c[1])} "
            f"WHEN {t} >= 30 AND {t} < 45 THEN {q(c[2])} WHEN {t} >= 45 AND {t} <= 60 THEN {q(c[3])} "
            f"WHEN {t} > 60 AND {t} <= 120 THEN {q(c[4])} WHEN {t} > 120 AND {t} <= 240 THEN {q(c[5])} "
            f"WHEN {t} > 240 AND {t} <= 720 THEN {q(c[6])} WHEN {t} > 720 THEN {q(c[7])} END")


def position_category(x: str) -> str:
    c = COMMENT_POSITION
    return (f"CASE WHEN {x} <= 10 THEN {q(c[0])} WHEN {x} > 10 AND {x} <= 50 THEN {q(c[1])} "
            f"WHEN {x} > 50 AND {x} <= 100 THEN {q(c[2])} WHEN {x} > 100 AND {x} <= 200 THEN {q(c[3])} "
            f"WHEN {x} > 200 THEN {q(c[4])} END")


def comment_id(a: str = "") -> str:
    """SQL twin of ``adapters.comment_id`` (``a`` = table alias with dot)."""
    parts = [f"{a}l_orderkey", f"{a}l_partkey", f"{a}l_suppkey", f"{a}l_linenumber",
             f"CAST({a}l_quantity AS BIGINT)", f"CAST(round({a}l_extendedprice * 100) AS BIGINT)",
             f"CAST(round({a}l_discount * 100) AS BIGINT)", f"CAST(round({a}l_tax * 100) AS BIGINT)",
             f"{a}l_returnflag", f"{a}l_linestatus", f"strftime({a}l_shipdate, '%Y%m%d')"]
    return "concat_ws('-', " + ", ".join(parts) + ")"


def tag(k: str) -> str:
    return f"CASE WHEN {k} % 10 < 7 THEN 'trn' ELSE 'tst' END"


def sample_hash(key: str, seed: int) -> str:
    return f"('0x' || substr(md5('{seed}:' || {key}), 1, 13))::BIGINT"


def minutes_between(later: str, earlier: str) -> str:
    return f"((epoch_us({later}) - epoch_us({earlier})) / 60000000.0::DOUBLE)"


# ------------------------------------------------------------------ feature pipeline
def ranked_keywords_cte() -> str:
    return f"""
pairs AS (SELECT DISTINCT l.l_orderkey AS articleID, p.p_name AS new
          FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
freq AS (SELECT new, count(*) AS N FROM pairs GROUP BY new),
rk AS (SELECT new, N, row_number() OVER (ORDER BY N DESC, new ASC) AS keyword_rank,
              {topic_sql('new')} AS topic FROM freq),
ranked AS (SELECT p.articleID, p.new, r.N, r.keyword_rank, r.topic FROM pairs p JOIN rk r ON p.new = r.new)"""


def article_kw_cte() -> str:
    return """
topk AS (SELECT articleID, new, keyword_rank,
                row_number() OVER (PARTITION BY articleID ORDER BY keyword_rank) AS o FROM ranked),
wide AS (SELECT articleID,
                max(CASE WHEN o = 1 THEN new END) AS kw1, max(CASE WHEN o = 2 THEN new END) AS kw2,
                max(CASE WHEN o = 3 THEN new END) AS kw3,
                max(CASE WHEN o = 1 THEN keyword_rank END) AS kwr1,
                max(CASE WHEN o = 2 THEN keyword_rank END) AS kwr2,
                max(CASE WHEN o = 3 THEN keyword_rank END) AS kwr3
         FROM topk WHERE o <= 3 GROUP BY articleID),
per AS (SELECT articleID, min(topic) AS topic, CAST(sum(N) AS BIGINT) AS kwr,
               min(keyword_rank) AS minkwr, arg_min(new, keyword_rank) AS specific
        FROM ranked GROUP BY articleID),
kwf AS (SELECT per.*, wide.kw1, wide.kw2, wide.kw3, wide.kwr1, wide.kwr2, wide.kwr3
        FROM per JOIN wide ON per.articleID = wide.articleID)"""


def features_cte(seed: int = 19790324, fraction: float = 0.70) -> str:
    """CTEs ending in ``trn``: the exact 70 % training split with a matched article."""
    snip = sentiment("a.snippet")
    body = sentiment("c.commentBody")
    rd = readability("c.commentBody")
    return f"""WITH
{ranked_keywords_cte().strip()},
{article_kw_cte().strip()},
art AS (SELECT o.o_orderkey AS articleID, CAST(o.o_orderdate AS TIMESTAMP) AS pubDate_dt,
               o.o_orderpriority AS byline, {tag('o.o_orderkey')} AS type, d.text AS snippet
        FROM orders o LEFT JOIN documents d ON d.doc_id = o.o_orderkey),
art2 AS (SELECT a.*, hour(a.pubDate_dt) AS hr, dayname(a.pubDate_dt) AS dow, {snip} AS snip_sent
         FROM art a),
artf AS (SELECT a.articleID, a.type, a.byline, a.pubDate_dt, a.dow,
                {time_of_day('a.hr')} AS timeofday,
                CASE WHEN a.dow IN ('Sunday', 'Saturday') THEN 'Weekend' ELSE 'Weekday' END AS wkdy,
                a.snip_sent, {sentiment_bucket('a.snip_sent')} AS snip_cat,
                k.kw1, k.kw2, k.kw3, k.kwr1, k.kwr2, k.kwr3, k.topic, k.specific, k.kwr, k.minkwr
         FROM art2 a LEFT JOIN kwf k ON a.articleID = k.articleID),
com0 AS (SELECT {comment_id('l.')} AS commentID,
                l.l_orderkey AS articleID, CAST(l.l_linenumber AS BIGINT) AS commentSequence,
                l.l_suppkey AS userID, CAST(l.l_shipdate AS TIMESTAMP) AS approveDate_ts,
                (l.l_returnflag = 'R') AS editorsSelection, CAST(l.l_quantity AS BIGINT) AS recommendations,
                {tag('l.l_orderkey')} AS type, cv.text AS commentBody
         FROM lineitem l LEFT JOIN conversations cv ON cv.conv_id = l.l_orderkey AND cv.turn = l.l_linenumber),
com1 AS (SELECT c.*, row_number() OVER (PARTITION BY c.articleID ORDER BY c.commentSequence, c.commentID) AS com_ord,
                {body} AS com_sent, CAST(length(c.commentBody) AS BIGINT) AS comment_length,
                {rd['readFR']} AS readFR, {rd['readCL']} AS readCL
         FROM com0 c),
com_final AS (SELECT c.*, {position_category('c.com_ord')} AS com_pos_cat,
                     {sentiment_bucket('c.com_sent')} AS com_cat,
                     f.byline, f.kw1, f.kw2, f.kw3, f.kwr1, f.kwr2, f.kwr3, f.timeofday, f.wkdy, f.dow,
                     f.topic, f.specific, f.kwr, f.minkwr, f.snip_sent, f.snip_cat, f.pubDate_dt,
                     CASE WHEN round_even({minutes_between('c.approveDate_ts', 'f.pubDate_dt')}, 0) < 0 THEN 0.0
                          ELSE round_even({minutes_between('c.approveDate_ts', 'f.pubDate_dt')}, 0) + 0.0 END
                          AS time_to_post
              FROM com1 c LEFT JOIN artf f ON c.articleID = f.articleID AND c.type = f.type),
com_final2 AS (SELECT *, {ttp_category('time_to_post')} AS time_to_post_cat FROM com_final),
trn_all AS (SELECT *, row_number() OVER (ORDER BY {sample_hash('commentID', seed)}, commentID) AS __rn,
                   count(*) OVER () AS __n
            FROM com_final2 WHERE type = 'trn'),
trn AS (SELECT * EXCLUDE (__rn, __n) FROM trn_all
        WHERE __rn <= round_even({fraction!r}::DOUBLE * __n, 0) AND pubDate_dt IS NOT NULL)
"""
