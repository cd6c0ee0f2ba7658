"""The registered queries in DuckDB SQL, written independently of the Spark code.

Where the two engines differ the SQL takes another road to the same result: RE2
has no look-around, the graph ranking multiplies explicit sentence pairs, and the
longest common subsequence is the textbook table.
"""

from __future__ import annotations

from ..functions import fixed_values as fv
from ..functions import porter
from ..operators.assistant import DEFAULTS, PromptTexts
from . import request_log

STOP_LIST = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in fv.ENGLISH_STOP_WORDS) + "]"
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
BREAK = r"""'([a-z0-9")][.!?])\s+([A-Z"(])', '\1' || chr(30) || '\2', 'g'"""
TEXTS = PromptTexts()


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _decode(x: str) -> str:
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"')):
        x = f"regexp_replace({x}, '&{name};', '{char}', 'g')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def _collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}+', ' ', 'g'))"


def _title_case(x: str) -> str:
    runs = rf"regexp_extract_all({x}, '[\p{{Lu}}\p{{Ll}}\p{{Lt}}]+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+')"
    cased = "CASE WHEN r[1] = 'ß' THEN 'Ss' ELSE upper(r[1]) END || lower(r[2:])"
    return f"array_to_string(list_transform({runs}, lambda r: {cased}), '')"


def _split(x: str) -> str:
    once = f"regexp_replace({x}, {BREAK})"
    return f"string_split(regexp_replace({once}, {BREAK}), chr(30))"


def _terms(x: str) -> str:
    words = f"regexp_extract_all(lower(coalesce({x}, '')), '[a-z]{{2,}}')"
    return f"list_filter({words}, lambda w: NOT list_contains({STOP_LIST}, w))"


def _wire(x: str) -> str:
    return rf"""regexp_replace(regexp_replace({x}, '\s*<[A-Z0-9.\-]{{1,10}}>', '', 'g'), '<([^<>]+)>', '\1', 'g')"""


def _sanitise(x: str, limit: int | None = None) -> str:
    plain = _wire(rf"regexp_replace({x}, '[\x00-\x08\x0b-\x1f]', ' ', 'g')")
    mail = rf"regexp_replace({plain}, '[\p{{L}}\p{{N}}_.+-]+@[\p{{L}}\p{{N}}_-]+\.[\p{{L}}\p{{N}}_.-]+', '[EMAIL]', 'g')"
    inner = r"[\p{Nd}\s\x0b\x1c-\x1f\x{85}\p{Z}\-()]"
    safe = rf"regexp_replace({mail}, '(^|[^\p{{Nd}}])(\+?\p{{Nd}}{inner}{{8,}}\p{{Nd}})', '\1[PHONE]', 'g')"
    return f"substr({safe}, 1, {limit})" if limit else safe


def _fingerprint(x: str) -> str:
    return f"CASE WHEN coalesce(length({x}), 0) = 0 THEN '-' ELSE substr(sha256({x}), 1, 12) END"


def _filled(template: str, values: dict[str, str]) -> str:
    """A {name} template as an SQL concatenation."""
    sql = _quoted(template)
    for name, expr in values.items():
        sql = sql.replace("{" + name + "}", f"' || {expr} || '")
    return sql


def _choice(mapping, column: str) -> str:
    whens = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in mapping.items())
    return f"CASE {column} {whens} END"


CUT = "instr(text, chr(10))"
LOG_VALUES = {
    "conv": "conv_id",
    "split": "CASE WHEN conv_id % 10 < 7 THEN 'training' ELSE 'test' END",
    "text": "text",
}


def _log_line(lines: list[str]) -> str:
    whens = " ".join(f"WHEN {n} THEN {_filled(line, LOG_VALUES)}" for n, line in enumerate(lines))
    return f"CASE (conv_id + turn) % 10 {whens} END"


# name -> (needed tables, body)
TABLES: dict[str, tuple[list[str], str]] = {
    "raw": ([], f"""
        SELECT split || '_' || doc_id AS doc_id, split, coalesce(source, 'none') AS category,
               nullif({_title_case("title0")}, '') AS title, nullif({_collapse(_decode("body0"))}, '') AS text
        FROM (SELECT doc_id, source, CASE WHEN doc_id % 10 < 7 THEN 'training' ELSE 'test' END AS split,
                     regexp_replace({_decode(f"CASE WHEN {CUT} > 0 THEN substr(text, 1, {CUT} - 1) ELSE text END")},
                                    '^{SPACE}+|{SPACE}+$', '', 'g') AS title0,
                     CASE WHEN {CUT} > 0 THEN substr(text, {CUT} + 1) ELSE '' END AS body0
              FROM documents)"""),
    "clean": (["raw"], rf"""
        SELECT * FROM (
            SELECT doc_id, split, category, title,
                   trim(regexp_replace({_wire(r"regexp_replace(text, '\s*Reuter\s*\x03?\s*$', '')")}, '\s+', ' ', 'g'))
                   AS text
            FROM raw WHERE text IS NOT NULL)
        WHERE length(text) > 0"""),
    "docs": (["clean"], f"""
        SELECT *, len(sentences) AS n_sentences, len(tokens) AS n_tokens_clean, length(text) AS n_chars,
               n_words / greatest(len(sentences), 1) AS avg_sent_len
        FROM (SELECT *, list_filter({_split("text")}, lambda s: length(s) > 0) AS sentences,
                     {_terms("text")} AS tokens, len(string_split(text, ' ')) AS n_words FROM clean)
        WHERE len(sentences) >= 5 AND n_words >= 80"""),
    "sent": (["docs"], f"""
        SELECT doc_id, n_sentences, sent_idx, sentence, {_terms("sentence")} AS terms,
               len(string_split(sentence, ' ')) AS s_words
        FROM (SELECT doc_id, n_sentences, unnest(sentences) AS sentence,
                     unnest(range(len(sentences))) AS sent_idx FROM docs)"""),
    "words": (["docs"], """
        SELECT word, count(*) AS count FROM (SELECT unnest(tokens) AS word FROM docs) GROUP BY word"""),
    "tf": (["docs"], """
        SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM docs)
        GROUP BY doc_id, term"""),
    "idf": (["tf"], """
        SELECT term, count(DISTINCT doc_id) AS df,
               ln(((SELECT count(*) FROM docs) + 1) / (count(DISTINCT doc_id) + 1)) + 1 AS idf
        FROM tf GROUP BY term"""),
    "weights": (["tf", "idf"], "SELECT doc_id, term, tf, tf * idf AS w FROM tf JOIN idf USING (term)"),
    "keywords": (["weights"], """
        SELECT doc_id, list(term ORDER BY r) AS keywords
        FROM (SELECT doc_id, term,
                     row_number() OVER (PARTITION BY doc_id ORDER BY round(w, 9) DESC, term) AS r FROM weights)
        WHERE r <= 10 GROUP BY doc_id"""),
    "scores": (["sent", "weights"], """
        SELECT *, wsum / sqrt(greatest(n_terms, 1)) AS tfidf_norm,
               wsum / sqrt(greatest(n_terms, 1)) * (1 + 1 / (1 + sent_idx)) AS tfidf_score
        FROM (SELECT s.doc_id, s.sent_idx, coalesce(sum(w.w), 0) AS wsum, count(t.term) AS n_terms
              FROM sent s
              LEFT JOIN (SELECT doc_id, sent_idx, unnest(terms) AS term FROM sent) t USING (doc_id, sent_idx)
              LEFT JOIN weights w ON w.doc_id = t.doc_id AND w.term = t.term
              GROUP BY s.doc_id, s.sent_idx)"""),
    "lead3": (["docs"], "SELECT doc_id, array_to_string(sentences[1:3], ' ') AS lead3 FROM docs"),
    "tfidf": (["scores", "sent"], """
        SELECT doc_id, string_agg(sentence, ' ' ORDER BY sent_idx) AS tfidf_summary
        FROM (SELECT doc_id, sent_idx,
                     row_number() OVER (PARTITION BY doc_id ORDER BY round(tfidf_score, 9) DESC, sent_idx) AS r
              FROM scores) JOIN sent USING (doc_id, sent_idx)
        WHERE r <= 3 GROUP BY doc_id"""),
    "vectors": (["sent"], rf"""
        SELECT doc_id, n_sentences, sent_idx, term, df,
               w / sqrt(sum(w * w) OVER (PARTITION BY doc_id, sent_idx)) AS x
        FROM (SELECT *, tf * (ln((1 + n_sentences) / (1 + df)) + 1) AS w
              FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, term) AS df
                    FROM (SELECT doc_id, n_sentences, sent_idx, term, count(*) AS tf
                          FROM (SELECT doc_id, n_sentences, sent_idx,
                                       unnest(regexp_extract_all(lower(sentence), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term
                                FROM sent)
                          WHERE NOT list_contains({STOP_LIST}, term)
                          GROUP BY ALL)))"""),
    "edges": (["vectors"], """
        SELECT a.doc_id, a.n_sentences, a.sent_idx AS i, b.sent_idx AS j, sum(a.x * b.x) AS sim
        FROM vectors a JOIN vectors b ON a.doc_id = b.doc_id AND a.term = b.term AND a.sent_idx <> b.sent_idx
        GROUP BY ALL"""),
    "mass": (["edges"], "SELECT doc_id, n_sentences, i, sum(sim) AS mass FROM edges GROUP BY ALL"),
    "moves": (["edges", "mass"], """
        SELECT e.doc_id, e.n_sentences, e.i, e.j, e.sim / m.mass AS p
        FROM edges e JOIN mass m ON e.doc_id = m.doc_id AND e.i = m.i"""),
    "rounds": (["moves"], """
        SELECT doc_id, n_sentences, i AS node, 0 AS round, 1 / n_sentences AS rank FROM mass
        UNION ALL
        SELECT m.doc_id, m.n_sentences, m.j, any_value(r.round) + 1,
               (1 - 0.85::DOUBLE) / m.n_sentences + 0.85::DOUBLE * sum(m.p * r.rank)
        FROM rounds r JOIN moves m ON r.doc_id = m.doc_id AND r.node = m.i
        WHERE r.round < 50 GROUP BY m.doc_id, m.n_sentences, m.j"""),
    "ranks": (["rounds", "mass", "sent"], """
        SELECT s.doc_id, s.sent_idx, s.sentence, coalesce(m.mass, 0) AS similarity,
               coalesce(r.rank, (1 - 0.85::DOUBLE) / s.n_sentences) AS rank
        FROM sent s
        LEFT JOIN mass m ON m.doc_id = s.doc_id AND m.i = s.sent_idx
        LEFT JOIN rounds r ON r.doc_id = s.doc_id AND r.node = s.sent_idx AND r.round = 50"""),
    "textrank": (["ranks"], """
        SELECT doc_id, string_agg(sentence, ' ' ORDER BY sent_idx) AS textrank_summary
        FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(rank, 9) DESC, sent_idx) AS r FROM ranks)
        WHERE r <= 3 GROUP BY doc_id"""),
    "features": (["sent", "scores", "docs"], f"""
        SELECT *, sent_idx / greatest(n_sentences - 1, 1) AS rel_pos,
               percent_rank() OVER (PARTITION BY doc_id ORDER BY round(tfidf_norm, 9)) AS tfidf_pct,
               row_number() OVER (PARTITION BY doc_id ORDER BY overlap DESC, sent_idx) AS overlap_rank
        FROM (SELECT s.doc_id, s.n_sentences, s.sent_idx, c.tfidf_norm, s.s_words,
                     len(list_intersect(s.terms, {_terms("d.title")}))::DOUBLE AS overlap,
                     length(regexp_replace(s.sentence, '[^0-9]', '', 'g'))::DOUBLE AS n_digits,
                     len(list_filter(string_split(s.sentence, ' '), lambda w: regexp_matches(w, '^[A-Z]')))
                       / s.s_words AS cap_ratio
              FROM sent s JOIN scores c USING (doc_id, sent_idx) JOIN docs d USING (doc_id))"""),
    "summaries": (["docs", "lead3", "tfidf", "textrank", "keywords"], """
        SELECT doc_id, category, title, n_words, lead3, tfidf_summary, textrank_summary, keywords
        FROM docs LEFT JOIN lead3 USING (doc_id) LEFT JOIN tfidf USING (doc_id)
        LEFT JOIN textrank USING (doc_id) LEFT JOIN keywords USING (doc_id)"""),
    "long": (["summaries"], """
        SELECT doc_id, title, n_words, keywords, unnest(['Lead-3', 'Spark TF-IDF', 'TextRank']) AS model,
               unnest([lead3, tfidf_summary, textrank_summary]) AS summary
        FROM summaries WHERE keywords IS NOT NULL"""),
    "rtok": (["long"], """
        SELECT doc_id, model, regexp_extract_all(lower(coalesce(title, '')), '[a-z0-9]+') AS ref,
               regexp_extract_all(lower(summary), '[a-z0-9]+') AS cand FROM long"""),
    "lcs": (["rtok"], """
        SELECT doc_id, model, CASE WHEN len(ref) = 0 THEN 0 ELSE list_reduce(
            list_filter(cand, lambda w: list_contains(ref, w)),
            lambda above, w: list_reduce(
                range(1, len(ref) + 1),
                lambda line, j: list_append(line,
                    CASE WHEN ref[j] = w THEN above[j] + 1 ELSE greatest(above[j + 1], line[j]) END),
                [0::BIGINT]),
            list_transform(range(len(ref) + 1), lambda _: 0::BIGINT))[-1] / len(ref) END AS recall
        FROM rtok"""),
    "coverage": (["long"], """
        SELECT doc_id, model,
               len(list_filter(keywords, lambda k: list_contains(
                   regexp_extract_all(lower(summary), '[a-z]{2,}'), k))) / len(keywords) AS coverage FROM long"""),
    "sizes": (["long"], r"""
        SELECT doc_id, model, len(regexp_extract_all(summary, '[^\s]+')) AS words,
               len(regexp_extract_all(summary, '[^\s]+')) / n_words AS ratio FROM long"""),
    "log": ([], f"""
        SELECT conv_id AS session, turn,
               CASE WHEN conv_id % 3 = 0 THEN {_log_line(request_log.SECOND_LINES)}
                    ELSE {_log_line(request_log.LINES)} END AS line
        FROM conversations"""),
    "commands": (["log", "raw"], f"""
        SELECT session, turn, CASE WHEN word IN ('/doc', '/paste', '/prompt', '/summarize', '/ask', '/help', '/quit')
                 OR (word = '/lang' AND argument <> '')
                 OR (word = '/style' AND argument IN ({", ".join(map(_quoted, TEXTS.styles))}))
                 OR (word = '/length' AND argument IN ({", ".join(map(_quoted, TEXTS.lengths))}))
               THEN word[2:] END AS command, argument
        FROM (SELECT session, turn, split_part(line, ' ', 1) AS word,
                     CASE WHEN instr(line, ' ') = 0 THEN '' ELSE substr(line, instr(line, ' ') + 1) END AS argument
              FROM (SELECT session, turn, regexp_replace(line, '^{SPACE}+|{SPACE}+$', '', 'g') AS line FROM log)
              WHERE line <> '')"""),
    "open_rows": (["commands"], """
        SELECT * FROM (SELECT *, count(*) FILTER (command = 'quit') OVER (
                           PARTITION BY session ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS quits
                       FROM commands) WHERE quits = 0"""),
    "settings": (["open_rows", "raw"], f"""
        SELECT o.*, CASE WHEN command = 'style' THEN argument END AS new_style,
               CASE WHEN command = 'length' THEN argument END AS new_length,
               CASE WHEN command = 'lang' THEN {_title_case("argument")} END AS new_language,
               CASE WHEN command = 'paste' THEN CASE argument WHEN '' THEN 'empty:' ELSE 'paste:' END || session || ':' || turn
                    WHEN command = 'doc' AND r.doc_id IS NOT NULL THEN 'corpus:' || r.doc_id END AS set_ref
        FROM open_rows o LEFT JOIN (SELECT doc_id FROM raw WHERE text IS NOT NULL) r ON r.doc_id = o.argument"""),
    "state": (["settings"], f"""
        SELECT *, CASE WHEN command IS NULL THEN 'unknown_command'
                       WHEN command = 'doc' AND set_ref IS NULL THEN 'unknown_document'
                       WHEN command IN ('summarize', 'ask') AND (doc_ref IS NULL OR doc_ref LIKE 'empty:%')
                         THEN 'no_document'
                       ELSE 'ok' END AS status
        FROM (SELECT session, turn, command, argument, set_ref,
                     coalesce(last_value(new_style IGNORE NULLS) OVER w, '{DEFAULTS["style"]}') AS style,
                     coalesce(last_value(new_length IGNORE NULLS) OVER w, '{DEFAULTS["length"]}') AS length,
                     coalesce(last_value(new_language IGNORE NULLS) OVER w, '{DEFAULTS["language"]}') AS language,
                     last_value(set_ref IGNORE NULLS) OVER w AS doc_ref
              FROM settings WINDOW w AS (PARTITION BY session ORDER BY turn
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""),
    "bodies": (["raw", "state"], """
        SELECT 'corpus:' || doc_id AS doc_ref, title, text FROM raw WHERE text IS NOT NULL
        UNION ALL SELECT set_ref, NULL, argument FROM state WHERE command = 'paste'"""),
    "local_texts": ([], ""),
    "local_sent": (["local_texts"], f"""
        SELECT doc_id, n, sent_idx, sentence, {_terms("sentence")} AS terms
        FROM (SELECT doc_id, len(sentences) AS n, unnest(sentences) AS sentence,
                     unnest(range(len(sentences))) AS sent_idx
              FROM (SELECT doc_id, list_filter({_split(_collapse("text"))},
                                               lambda s: len(string_split(s, ' ')) >= 4) AS sentences
                    FROM local_texts))"""),
    "local_uses": (["local_sent"], "SELECT doc_id, n, sent_idx, unnest(terms) AS term FROM local_sent"),
    "local_stats": (["local_uses"], """
        SELECT doc_id, term, count(*) * (ln((any_value(n) + 1) / (count(DISTINCT sent_idx) + 1)) + 1) AS weight
        FROM local_uses GROUP BY doc_id, term"""),
    "local_best": (["local_sent", "local_uses", "local_stats"], """
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, sent_idx) AS r
        FROM (SELECT s.doc_id, s.sent_idx, s.sentence,
                     coalesce(w.total, 0) / sqrt(greatest(len(s.terms), 1)) * (1 + 1 / (1 + s.sent_idx)) AS score
              FROM local_sent s
              LEFT JOIN (SELECT u.doc_id, u.sent_idx, sum(weight) AS total
                         FROM local_uses u JOIN local_stats t ON t.doc_id = u.doc_id AND t.term = u.term
                         GROUP BY u.doc_id, u.sent_idx) w USING (doc_id, sent_idx))"""),
}


def _with(final: str, *needed: str, **replaced: tuple[list[str], str]) -> str:
    tables = {**TABLES, **replaced}
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for other in tables[name][0]:
                if other != name:
                    visit(other)
            order.append(name)

    for name in needed:
        visit(name)
    parts = [f"{n} AS {'' if n == 'rounds' else 'MATERIALIZED '}({tables[n][1]})" for n in order]
    return f"WITH RECURSIVE {', '.join(parts)} {final}" if parts else final


def _grams(n: int) -> str:
    def grams(side: str) -> str:
        if n == 1:
            return side
        return f"list_transform(range(1, len({side})), lambda k: {side}[k] || ' ' || {side}[k + 1])"

    return f"""
        SELECT doc_id, model,
               CASE WHEN coalesce(sum(ref_n), 0) = 0 THEN 0
                    ELSE coalesce(sum(least(ref_n, cand_n)), 0) / sum(ref_n) END AS recall
        FROM (SELECT doc_id, model, gram, count(*) FILTER (side = 'ref') AS ref_n,
                     count(*) FILTER (side = 'cand') AS cand_n
              FROM (SELECT doc_id, model, 'ref' AS side, unnest({grams("ref")}) AS gram FROM rtok
                    UNION ALL SELECT doc_id, model, 'cand', unnest({grams("cand")}) FROM rtok
                    UNION ALL SELECT doc_id, model, 'none', NULL FROM rtok)
              GROUP BY ALL)
        GROUP BY doc_id, model"""


def _histogram(bins: int) -> str:
    return f"""
        SELECT b.bin, lo + bin * (hi - lo) / {bins} AS bin_from, lo + (bin + 1) * (hi - lo) / {bins} AS bin_to,
               count(v.v) AS n
        FROM (SELECT unnest(range({bins})) AS bin) b
        CROSS JOIN (SELECT min(v)::DOUBLE AS lo, max(v)::DOUBLE AS hi FROM v)
        LEFT JOIN v ON least(floor((v.v - lo) * {bins} / (hi - lo)), {bins - 1}) = b.bin
        GROUP BY ALL"""


def _values(table: str, value: str, cap: int) -> tuple[list[str], str]:
    return [table], f"SELECT least({value}, {cap}) AS v FROM {table} WHERE {value} IS NOT NULL"


def _rounded(sql: str, *columns: str) -> str:
    changes = ", ".join(f"round({c}, 6) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({changes}) FROM ({sql})"


def _measure(n: str) -> str:
    """How often a vowel is followed by a consonant in the first ``n`` letters, read off their shape ``s``."""
    return f"((length(left(s, {n})) - length(replace(left(s, {n}), 'vc', ''))) // 2)"


def _short_end(word: str) -> str:
    shape = f"left(s, length({word}))"
    return f"(({shape} LIKE '%cvc' AND right({word}, 1) NOT IN ('w', 'x', 'y')) OR {shape} = 'vc')"


def _suffix_rules(rules: dict[str, str], least: int, extra: dict[str, str]) -> str:
    """The rule of the longest fitting suffix alone; it asks for a measure beyond ``least`` before the suffix."""
    cases = []
    for suffix in sorted(rules, key=len, reverse=True):
        stem = f"length(w) - {len(suffix)}"
        measured = f"{stem} + 1" if suffix == "logi" else stem
        cases.append(
            f"WHEN w LIKE '%{suffix}' THEN CASE WHEN {_measure(measured)} > {least} AND {extra.get(suffix, 'true')} "
            f"THEN left(w, {stem}) || '{rules[suffix]}' ELSE w END")
    return f"CASE {' '.join(cases)} ELSE w END"


#: The shape of a word: v for a vowel, c for any other character; y is a vowel after a consonant.
SHAPE = """list_reduce(string_split(w, ''), lambda shape, x: shape || CASE
    WHEN x IN ('a', 'e', 'i', 'o', 'u') OR (x = 'y' AND shape LIKE '%c') THEN 'v' ELSE 'c' END, '')"""
_UNDOUBLED = f"""
    CASE WHEN NOT cut THEN w WHEN right(w, 2) IN ('at', 'bl', 'iz') THEN w || 'e'
         WHEN length(w) > 1 AND w[-1] = w[-2] AND left(s, length(w)) LIKE '%c'
           THEN CASE WHEN w[-1] IN ('l', 's', 'z') THEN w ELSE left(w, length(w) - 1) END
         WHEN {_measure("length(w)")} = 1 AND {_short_end("w")} THEN w || 'e' ELSE w END"""
_E = "length(w) - 1"
_NO_E = f"""
    CASE WHEN w LIKE '%e' AND ({_measure(_E)} > 1 OR ({_measure(_E)} = 1 AND NOT {_short_end(f"left(w, {_E})")}))
         THEN left(w, {_E}) ELSE w END"""
_PAST = "CASE WHEN w LIKE '%ed' THEN 2 WHEN w LIKE '%ing' THEN 3 END"
#: The published steps in their order, each over the words ``w`` of the one before and their shapes ``s``.
STEPS = [
    """CASE WHEN w LIKE '%ies' THEN left(w, length(w) - CASE length(w) WHEN 4 THEN 1 ELSE 2 END)
            WHEN w LIKE '%sses' THEN left(w, length(w) - 2)
            WHEN w LIKE '%s' AND w NOT LIKE '%ss' THEN left(w, length(w) - 1) ELSE w END""",
    _UNDOUBLED,
    """CASE WHEN w LIKE '%y' AND length(w) > 2 AND s[length(w) - 1] = 'c' THEN left(w, length(w) - 1) || 'i' ELSE w END""",
    f"CASE WHEN w LIKE '%alli' AND {_measure('length(w) - 4')} > 0 THEN left(w, length(w) - 2) ELSE w END",
    _suffix_rules(porter.STEP_2, 0, {}),
    _suffix_rules(porter.STEP_3, 0, {}),
    _suffix_rules(dict.fromkeys(porter.STEP_4, ""), 1, {"ion": "w[length(w) - 3] IN ('s', 't')"}),
    _NO_E,
    f"CASE WHEN w LIKE '%ll' AND {_measure(_E)} > 1 THEN left(w, {_E}) ELSE w END",
]


def _stem_tables() -> dict[str, tuple[list[str], str]]:
    """``stems`` (word, stem) of the words in ``plain``, and ``rtok`` with every word replaced."""
    irregular = ", ".join(f"({_quoted(w)}, {_quoted(stem)})" for w, stem in porter.IRREGULAR.items())
    tables = {
        "plain": TABLES["rtok"],
        "stem_words": (["plain"], f"""
            SELECT DISTINCT word, word AS w FROM (SELECT unnest(ref || cand) AS word FROM plain)
            WHERE length(word) >= {porter.MIN_STEMMED_LENGTH}"""),
    }
    last = "stem_words"
    for i, step in enumerate(STEPS):
        source = f"SELECT *, {SHAPE} AS s FROM {last}"
        if step is _UNDOUBLED:  # the ending is cut first
            source = f"""
                SELECT word, s, cut, CASE
                    WHEN w LIKE '%ied' THEN left(w, length(w) - CASE length(w) WHEN 4 THEN 1 ELSE 2 END)
                    WHEN w LIKE '%eed' THEN CASE WHEN {_measure("length(w) - 3")} > 0 THEN left(w, length(w) - 1) ELSE w END
                    WHEN cut THEN left(w, length(w) - {_PAST}) ELSE w END AS w
                FROM (SELECT *, w NOT LIKE '%ied' AND w NOT LIKE '%eed' AND {_PAST} IS NOT NULL
                             AND contains(left(s, length(w) - {_PAST}), 'v') AS cut FROM ({source}))"""
        tables[f"stem_{i}"] = ([last], f"SELECT word, {step} AS w FROM ({source})")
        last = f"stem_{i}"
    tables["stems"] = ([last], f"""
        SELECT word, coalesce(i.stem, w) AS stem FROM {last} LEFT JOIN (VALUES {irregular}) i(irregular, stem) ON word = irregular""")
    tables["rtok"] = (["plain", "stems"], """
        SELECT p.doc_id, p.model, coalesce(list(coalesce(stem, t.word) ORDER BY i) FILTER (side = 'ref'), []) AS ref,
               coalesce(list(coalesce(stem, t.word) ORDER BY i) FILTER (side = 'cand'), []) AS cand
        FROM plain p
        LEFT JOIN (SELECT doc_id, model, 'ref' AS side, unnest(ref) AS word, unnest(range(len(ref))) AS i FROM plain
                   UNION ALL SELECT doc_id, model, 'cand', unnest(cand), unnest(range(len(cand))) FROM plain) t
          ON t.doc_id = p.doc_id AND t.model = p.model
        LEFT JOIN stems ON stems.word = t.word
        GROUP BY p.doc_id, p.model""")
    return tables


STEMMED = _stem_tables()


IN_USE = (["bodies", "state"], f"""
    SELECT doc_ref AS doc_id, {_sanitise("text", 12000)} AS text FROM bodies
    WHERE doc_ref IN (SELECT doc_ref FROM state) OR doc_ref IN (SELECT set_ref FROM state)""")
PROMPT_VALUES = {
    "style": _choice(TEXTS.styles, "style"),
    "length": _choice(TEXTS.lengths, "length"),
    "language": "language",
    "question": "substr(argument, 1, 500)",
    "document": f"CASE WHEN s.doc_ref IS NULL OR s.doc_ref LIKE 'empty:%' THEN 'document' ELSE coalesce({_sanitise('text', 12000)}, '') END",
}
USER_MESSAGE = f"""
    CASE WHEN command = 'ask' AND argument <> '' THEN {_filled(TEXTS.question, PROMPT_VALUES)}
         ELSE {_filled(TEXTS.summary, PROMPT_VALUES)} END"""
MEANS = """
    SELECT split_part(doc_id, '_', 1) AS split, model AS "Model", count(*) AS n_docs,
           round(avg(r1.recall), 3) AS "ROUGE1_R", round(avg(r2.recall), 3) AS "ROUGE2_R",
           round(avg(lcs.recall), 3) AS "ROUGEL_R", round(avg(coverage), 3) AS "KeyTermCoverage",
           round(avg(words), 3) AS "AvgSummaryWords", round(avg(ratio), 3) AS "CompressionRatio"
    FROM sizes JOIN r1 USING (doc_id, model) JOIN r2 USING (doc_id, model) JOIN lcs USING (doc_id, model)
    JOIN coverage USING (doc_id, model) GROUP BY ALL"""

ORACLES: dict[str, str] = {
    "ingest_title_body": _with("SELECT * FROM raw", "raw"),
    "ingest_title_body_stream": _with("SELECT * FROM raw", "raw"),
    "decode_entities": f"SELECT page_id, {_decode('html')} AS decoded FROM pages",
    "clean_documents": _with("SELECT * FROM clean", "clean"),
    "sentence_table": _with("SELECT * REPLACE (array_to_string(terms, ' ') AS terms) FROM sent", "sent"),
    "sentence_table_min4": _with(
        "SELECT doc_id, sent_idx, sentence FROM local_sent", "local_sent",
        local_texts=(["raw"], "SELECT doc_id, text FROM raw WHERE text IS NOT NULL")),
    "document_features": _with(
        """SELECT doc_id, category, title, array_to_string(tokens, ' ') AS tokens, n_chars, n_words, n_sentences,
                  n_tokens_clean, round(avg_sent_len, 6) AS avg_sent_len FROM docs""", "docs"),
    "corpus_profile": _with(
        """SELECT round(avg(n_words), 1) AS mean_words, quantile_disc(n_words, 0.5) AS median_words,
                  max(n_words) AS max_words, round(avg(n_sentences), 1) AS mean_sentences FROM docs""", "docs"),
    "eda_summary": _with(
        """UNPIVOT (SELECT (SELECT count(*) FROM raw)::DOUBLE AS docs_raw, count(*)::DOUBLE AS docs_kept,
                  sum(n_tokens_clean)::DOUBLE AS total_tokens, (SELECT count(*) FROM words)::DOUBLE AS vocabulary,
                  round(avg(n_words), 1) AS mean_words, quantile_cont(n_words, 0.5)::DOUBLE AS median_words,
                  max(n_words)::DOUBLE AS max_words, round(avg(n_sentences), 1) AS mean_sentences,
                  round(avg(avg_sent_len), 1) AS mean_words_per_sentence,
                  count(DISTINCT category)::DOUBLE AS categories FROM docs)
           ON COLUMNS(*) INTO NAME metric VALUE value""", "docs", "words"),
    "word_frequency": _with("SELECT * FROM words", "words"),
    "word_frequency_top20": _with("SELECT * FROM words ORDER BY count DESC, word LIMIT 20", "words"),
    "zipf_rank": _with("SELECT *, row_number() OVER (ORDER BY count DESC, word) AS rank FROM words", "words"),
    "length_histogram_raw": _with(
        _rounded(_histogram(50), "bin_from", "bin_to"), "v",
        v=_values("raw", r"len(string_split_regex(text, '\s+'))", 1500)),
    "length_histogram_clean": _with(
        _rounded(_histogram(40), "bin_from", "bin_to"), "v", v=_values("docs", "n_words", 1000)),
    "sentence_histogram": _with(
        """SELECT bin, 5 + 2 * bin AS bin_from, 7 + 2 * bin AS bin_to, count(v) AS n
           FROM (SELECT unnest(range(23)) AS bin)
           LEFT JOIN v ON least((v - 5) // 2, 22) = bin GROUP BY ALL""", "v", v=_values("docs", "n_sentences", 50)),
    "category_top10": _with(
        """SELECT category, count(*) AS n_docs FROM docs GROUP BY category
           ORDER BY n_docs DESC, category LIMIT 10""", "docs"),
    "length_box_by_category": _with(
        """SELECT category, n_docs, least(min(v) FILTER (v >= q1 - 1.5 * (q3 - q1)), q1) AS whisker_low, q1, median, q3,
                  greatest(max(v) FILTER (v <= q3 + 1.5 * (q3 - q1)), q3) AS whisker_high
           FROM (SELECT category, count(*) AS n_docs, quantile_cont(least(n_words, 1000), 0.25) AS q1,
                        quantile_cont(least(n_words, 1000), 0.5) AS median,
                        quantile_cont(least(n_words, 1000), 0.75) AS q3
                 FROM docs GROUP BY category ORDER BY n_docs DESC, category LIMIT 8)
           JOIN (SELECT category, least(n_words, 1000) AS v FROM docs) USING (category)
           GROUP BY category, n_docs, q1, median, q3""", "docs"),
    "document_frequency": _with(_rounded("SELECT * FROM idf", "idf"), "idf"),
    "document_frequency_incremental": _with(_rounded("SELECT * FROM idf", "idf"), "idf"),
    "distinct_words_sketched": _with(
        """SELECT category, count(DISTINCT word) AS distinct_words, true AS within_bound, true AS as_built_at_once
           FROM (SELECT category, unnest(tokens) AS word FROM docs) GROUP BY ROLLUP (category)""", "docs"),
    "length_quantiles_sketched": _with(
        """SELECT category, count(*) AS n_docs, true AS within_25, true AS within_50, true AS within_75
           FROM docs GROUP BY category""", "docs"),
    "tfidf_auc": _with(
        """SELECT n, n_positive, round((ranks - n_positive * (n_positive + 1) / 2) / n_positive / (n - n_positive), 9) AS auc
           FROM (SELECT count(*) AS n, count(*) FILTER (positive) AS n_positive, sum(middle) FILTER (positive) AS ranks
                 FROM (SELECT positive, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS middle
                       FROM (SELECT overlap_rank <= 2 AND overlap > 0 AS positive, round(tfidf_norm, 6) AS score
                             FROM features)))""", "features"),
    "term_weights": _with(_rounded("SELECT * FROM weights", "w"), "weights"),
    "keywords_top10": _with("SELECT doc_id, array_to_string(keywords, ' ') AS keywords FROM keywords", "keywords"),
    "sentence_scores": _with(_rounded("SELECT * FROM scores", "wsum", "tfidf_norm", "tfidf_score"), "scores"),
    "summary_lead3": _with("SELECT * FROM lead3", "lead3"),
    "summary_tfidf": _with("SELECT * FROM tfidf", "tfidf"),
    "textrank_vectors": _with(_rounded("SELECT * FROM vectors", "x"), "vectors"),
    "textrank_ranks": _with(
        "SELECT doc_id, sent_idx, round(similarity, 10) AS similarity, round(rank, 10) AS rank FROM ranks", "ranks"),
    "summary_textrank": _with("SELECT * FROM textrank", "textrank"),
    "summary_local": _with(
        """SELECT t.doc_id, coalesce(string_agg(sentence, ' ' ORDER BY sent_idx), '') AS local_summary
           FROM local_texts t LEFT JOIN (SELECT * FROM local_best WHERE r <= 3) b ON b.doc_id = t.doc_id
           GROUP BY t.doc_id""", "local_best",
        local_texts=(["raw"], f"SELECT doc_id, {_sanitise('text')} AS text FROM raw WHERE text IS NOT NULL")),
    "headline_labels": _with(
        """SELECT doc_id, sent_idx, overlap, overlap_rank,
                  (overlap_rank <= 2 AND overlap > 0)::INT::DOUBLE AS label FROM features""", "features"),
    "sentence_features": _with(_rounded(
        "SELECT * EXCLUDE (overlap, overlap_rank) FROM features", "tfidf_norm", "cap_ratio", "rel_pos", "tfidf_pct"),
        "features"),
    "summary_table": _with("SELECT * REPLACE (array_to_string(keywords, ' ') AS keywords) FROM summaries", "summaries"),
    "rouge_ngram": _with(
        f"SELECT * REPLACE (round(recall, 6) AS recall), 1::BIGINT AS n FROM ({_grams(1)}) UNION ALL "
        f"SELECT * REPLACE (round(recall, 6) AS recall), 2::BIGINT AS n FROM ({_grams(2)})", "rtok"),
    "stem_dictionary": _with("SELECT * FROM stems", "stems", **STEMMED),
    "rouge_ngram_stemmed_untrained": _with(
        f"SELECT * REPLACE (round(recall, 6) AS recall), 1::BIGINT AS n FROM ({_grams(1)}) UNION ALL "
        f"SELECT * REPLACE (round(recall, 6) AS recall), 2::BIGINT AS n FROM ({_grams(2)})", "rtok", **STEMMED),
    "rouge_lcs_stemmed_untrained": _with(_rounded("SELECT * FROM lcs", "recall"), "lcs", **STEMMED),
    "model_comparison_stemmed_untrained": _with(
        MEANS, "r1", "r2", "lcs", "coverage", "sizes", r1=(["rtok"], _grams(1)), r2=(["rtok"], _grams(2)), **STEMMED),
    "rouge_lcs": _with(_rounded("SELECT * FROM lcs", "recall"), "lcs"),
    "keyterm_coverage": _with(_rounded("SELECT * FROM coverage", "coverage"), "coverage"),
    "compression": _with(_rounded("SELECT * FROM sizes", "ratio"), "sizes"),
    "model_comparison": _with(
        MEANS, "r1", "r2", "lcs", "coverage", "sizes", r1=(["rtok"], _grams(1)), r2=(["rtok"], _grams(2))),
    "sanitise_documents":
        f"SELECT doc_id, {_sanitise('text')} AS safe_text, {_fingerprint('text')} AS doc_sha256 FROM documents",
    "sanitise_stream": f"SELECT doc_id, {_sanitise('text')} AS safe_text FROM documents",
    "abstractive_inputs": _with(
        """SELECT doc_id, title, substr(text, 1, 3000) AS model_input FROM raw
           WHERE split = 'test' AND text IS NOT NULL""", "raw"),
    "abstractive_inputs_top5": _with(
        """SELECT doc_id, title, substr(text, 1, 3000) AS model_input FROM raw
           WHERE split = 'test' AND text IS NOT NULL ORDER BY doc_id LIMIT 5""", "raw"),
    "session_state": _with("SELECT * EXCLUDE (argument) FROM state", "state"),
    "prompt_messages": _with(
        f"""SELECT session, turn, unnest(['system', 'user']) AS role,
                   unnest([{_quoted(TEXTS.system)}, user_message]) AS content
            FROM (SELECT session, turn, {USER_MESSAGE} AS user_message
                  FROM state s LEFT JOIN bodies b ON b.doc_ref = s.doc_ref
                  WHERE status = 'ok' AND command IN ('summarize', 'ask', 'prompt'))""", "state", "bodies"),
    "prompt_preview": _with(
        f"""SELECT session, turn, substr({USER_MESSAGE}, 1, 900) AS preview
            FROM state s LEFT JOIN bodies b ON b.doc_ref = s.doc_ref WHERE command = 'prompt'""", "state", "bodies"),
    "offline_reply": _with(
        f"""SELECT session, turn, command,
                   CASE WHEN status = 'no_document' THEN {_quoted(TEXTS.no_document)}
                        WHEN lower(language) <> 'english'
                          THEN {_filled(TEXTS.needs_model_language, {"language": "language"})}
                        WHEN command = 'ask' AND argument <> '' THEN {_quoted(TEXTS.needs_model_question)}
                        WHEN style = 'tldr' THEN coalesce(one, '')
                        WHEN style = 'bullets' THEN coalesce(bullets, '')
                        ELSE coalesce(three, '') END AS reply
            FROM state s LEFT JOIN (
                SELECT doc_id, string_agg(sentence, ' ' ORDER BY sent_idx) FILTER (r <= 1) AS one,
                       string_agg(sentence, ' ' ORDER BY sent_idx) AS three,
                       string_agg('- ' || sentence, chr(10) ORDER BY sent_idx) AS bullets
                FROM local_best WHERE r <= 3 GROUP BY doc_id) b ON b.doc_id = s.doc_ref
            WHERE command IN ('summarize', 'ask')""", "state", "local_best", local_texts=IN_USE),
    "confirmations": _with(
        rf"""SELECT session, turn, command,
                   CASE WHEN status = 'unknown_command' THEN {_quoted(TEXTS.unknown_command)}
                        WHEN status = 'unknown_document' THEN {_quoted(TEXTS.unknown_document)}
                        WHEN command = 'doc'
                          THEN 'loaded ''' || coalesce(title, 'null') || ''' ('
                               || len(regexp_extract_all(text, '[^\s]+')) || ' words)'
                        WHEN command = 'paste' THEN 'got ' || len(regexp_extract_all(text, '[^\s]+')) || ' words'
                        WHEN command = 'style' THEN 'style: ' || style
                        WHEN command = 'length' THEN 'length: ' || length
                        WHEN command = 'lang' THEN 'language: ' || language
                        ELSE command END AS reply
            FROM state s LEFT JOIN bodies b ON b.doc_ref = s.set_ref
            WHERE command IS NULL OR command NOT IN ('summarize', 'ask', 'prompt')""", "state", "bodies"),
    "audit_rows": _with(
        f"""SELECT session, turn, {_choice({"doc": "load_doc", "paste": "paste_doc", "summarize": "summarize",
                                            "ask": "ask"}, "command")} AS event, {_fingerprint("text")} AS doc_sha256
            FROM state s LEFT JOIN bodies b ON b.doc_ref = s.doc_ref
            WHERE status = 'ok' AND command IN ('doc', 'paste', 'summarize', 'ask')""", "state", "bodies"),
    "csv_roundtrip": _with("SELECT * FROM raw", "raw"),
    "parquet_roundtrip": _with(
        """SELECT doc_id, category, title, text, n_chars, n_words, n_sentences, n_tokens_clean,
                  round(avg_sent_len, 6) AS avg_sent_len FROM docs""", "docs"),
}
ORACLES["audit_append"] = ORACLES["audit_rows"]
for _batch in ("session_state", "prompt_messages", "audit_rows"):
    ORACLES[f"{_batch}_stream"] = ORACLES[_batch]
