"""SQL for the registered queries, computed from the base columns, never from
the derived ``<DOC>`` markup."""

from __future__ import annotations

from presswire.functions.annotate import (
    CHUNK_OF_POS, POS_DEFAULT, POS_SHAPES, POS_SUFFIXES, POS_UPPER, POS_UPPER_TAGS,
)
from presswire.functions.arabic import (
    ALIF_FROM, ALIF_TO, DIACRITICS, DIGITS_FROM, DIGITS_TO, PRO_MARKER, SEGMENT_MARKER, TATWEEL,
    YA_FROM, YA_TO,
)
from presswire.functions.segment import SENTENCE_END, TOKEN
from presswire.functions.text import ENTITIES, MARKUP
from presswire.operators.abbreviations import CANDIDATE, CLOSERS, LAST_WORD, LIMIT, OPENERS, SHARE, TYPE
from presswire.operators.sieves import PRONOUNS
from presswire.plans.corpus import ARABIC, LATIN
from presswire.plans.lexicons import GAZETTEER, LEMMAS, POLARITY, POS, RULES

CONTROL_EDGES = r"^[\x00-\x20]+|[\x00-\x20]+$"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def jt(x: str) -> str:
    return f"regexp_replace({x}, {q(CONTROL_EDGES)}, '', 'g')"


def rows(values: tuple, name: str, *columns: str) -> str:
    body = ", ".join("(" + ", ".join(q(v) for v in r) + ")" for r in values)
    return f"{name}({', '.join(columns)}) AS (VALUES {body})"


def finish(x: str) -> str:
    t = jt(x)
    return f"(CASE WHEN {t} = '' OR ends_with({t}, '.') THEN {t} ELSE {t} || '.' END)"


LINES = "string_split(text, chr(10))"
LANG = "CASE lang WHEN 'es' THEN 'ESP' ELSE 'ENG' END"
OWN_LANG = "CASE lang WHEN 'en' THEN 'ENG' WHEN 'es' THEN 'ESP' END"
KIND = "CASE source WHEN 'src1' THEN 'STORY' WHEN 'src3' THEN 'multi' WHEN 'src7' THEN 'other' ELSE 'story' END"
PLAIN_KIND = "CASE source WHEN 'src1' THEN 'STORY' ELSE 'story' END"
HEAD = jt("replace(substr(text, 1, 40), chr(10), ' ')")
DATE = "upper(source) || ' 2024-01-01'"
# The blank between the last paragraph and </TEXT> is a last, empty piece.
BODY = f"array_to_string(list_transform({LINES}, lambda p: {finish('p')}), ' ') || ' '"
BODY_XML = f"array_to_string(list_transform({LINES}, lambda p: {finish('p')}), ' ')"
STORY = "source NOT IN ('src3', 'src7')"

SENTENCES_OF = (
    "list_filter(list_transform(string_split(regexp_replace({x}, "
    + q(SENTENCE_END) + r", '\1' || chr(1), 'g'), chr(1)), lambda s: " + jt("s") + "), lambda s: s <> '')"
)
TOKENS_OF = "regexp_extract_all({x}, " + q(TOKEN) + ")"


def sentences_of(x: str) -> str:
    return SENTENCES_OF.replace("{x}", x)


def tokens_of(x: str) -> str:
    return TOKENS_OF.replace("{x}", x)


def stories_of(kind: str, where: str = "TRUE") -> str:
    return f"""stories AS (
  SELECT 'D' || doc_id AS doc_id, {LANG} AS language, {kind} AS type, {HEAD} AS head_line,
         {DATE} AS date_line, {BODY} AS body
  FROM documents WHERE {where})"""


# All documents; where routing is the feature, without the sources that deliver no stories.
STORIES, ROUTED = stories_of(PLAIN_KIND), stories_of(KIND, STORY)
SENTS = f"""sents AS (
  SELECT doc_id, language, unnest(s) AS sentence, generate_subscripts(s, 1)::BIGINT AS sentence_id
  FROM (SELECT doc_id, language, {sentences_of('body')} AS s FROM stories))"""
TOKS = f"""toks AS (
  SELECT doc_id, language, sentence_id, unnest(t) AS token, generate_subscripts(t, 1)::BIGINT AS idx
  FROM (SELECT doc_id, language, sentence_id, {tokens_of('sentence')} AS t FROM sents))"""
TO_TOKENS = f"{STORIES}, {SENTS}, {TOKS}"
TO_ROUTED_TOKENS = f"{ROUTED}, {SENTS}, {TOKS}"

LEMMA_CTE = rows(LEMMAS, "lemma_lex", "language", "word", "lemma")
POS_CTE = rows(POS, "pos_lex", "language", "word", "pos")
GAZ_CTE = rows(GAZETTEER, "gaz", "language", "phrase", "ner")
POL_CTE = rows(POLARITY, "pol", "language", "word", "weight")
LONGEST = max(len(p.split(" ")) for _, p, _ in GAZETTEER)

LEMMAED = """lemmaed AS (
  SELECT t.*, coalesce(l.lemma, lower(t.token)) AS lemma
  FROM toks t LEFT JOIN lemma_lex l ON l.language = t.language AND l.word = lower(t.token))"""

_SHAPES = " ".join(
    [f"WHEN regexp_matches(t.token, {q(p)}) THEN {q(tag)}" for p, tag in POS_SHAPES]
    + [f"WHEN regexp_matches(t.token, {q(POS_UPPER)}) AND ends_with(t.token, {q(x)}) THEN {q(tag)}" for x, tag in POS_UPPER_TAGS]
    + [f"WHEN ends_with(t.token, {q(x)}) THEN {q(tag)}" for x, tag in POS_SUFFIXES]
)
POSSED = f"""possed AS (
  SELECT t.*, coalesce(l.pos, CASE {_SHAPES} ELSE {q(POS_DEFAULT)} END) AS pos
  FROM toks t LEFT JOIN pos_lex l ON l.language = t.language AND l.word = lower(t.token))"""


def gazetteer_tags(gaz: str = "gaz", longest: int = LONGEST) -> str:
    """CTEs ``grams``, ``hits`` and ``tagged``: longest, then leftmost match per token."""
    over = "OVER (PARTITION BY doc_id, sentence_id ORDER BY idx)"
    grams = []
    for k in range(1, longest + 1):
        words = " || ' ' || ".join(
            f"lower(lead(token, {j}) {over})" if j else "lower(token)" for j in range(k)
        )
        grams.append(f"SELECT doc_id, language, sentence_id, idx, {k} AS k, {words} AS phrase FROM toks")
    return f"""grams AS ({' UNION ALL '.join(grams)}),
  hits AS (SELECT g.doc_id, g.sentence_id, g.idx AS first, g.k, z.ner
           FROM grams g JOIN {gaz} z ON z.language = g.language AND z.phrase = g.phrase),
  best AS (SELECT doc_id, sentence_id, cell, ner FROM (
             SELECT doc_id, sentence_id, cell, ner,
                    row_number() OVER (PARTITION BY doc_id, sentence_id, cell ORDER BY k DESC, first) AS rn
             FROM (SELECT *, unnest(range(first, first + k)) AS cell FROM hits)) WHERE rn = 1),
  tagged AS (SELECT t.*, coalesce(b.ner, 'O') AS ner FROM toks t
             LEFT JOIN best b ON b.doc_id = t.doc_id AND b.sentence_id = t.sentence_id AND b.cell = t.idx)"""


TAGGED = gazetteer_tags()


def runs(source: str, tag: str, name: str = "spans", commas: bool = True) -> str:
    """Gaps and islands over ``source``; ``mention`` is the run's text."""
    over = "PARTITION BY doc_id, sentence_id ORDER BY idx"
    word = "replace(token, ',', '')" if commas else "token"
    return f"""{name}_open AS (
    SELECT *, CASE WHEN {tag} <> 'O' AND coalesce(lag({tag}) OVER ({over}), 'O') <> {tag} THEN 1 ELSE 0 END AS o
    FROM {source}),
  {name}_isl AS (SELECT *, sum(o) OVER ({over}) AS isl FROM {name}_open),
  {name} AS (SELECT * FROM (
    SELECT doc_id, any_value(language) AS language, sentence_id, {tag} AS tag, min(idx) AS first, max(idx) AS last,
           coalesce(string_agg({word}, ' ' ORDER BY idx) FILTER ({word} <> ''), '') AS mention
    FROM {name}_isl WHERE {tag} <> 'O' GROUP BY doc_id, sentence_id, isl, {tag}) WHERE mention <> '')"""


SPANS = runs("tagged", "ner")
TO_SPANS = f"{GAZ_CTE}, {TO_TOKENS}, {TAGGED}, {SPANS}"

_CLASSES = " ".join(
    "WHEN pos IN (" + ", ".join(q(t) for t in tags) + f") THEN {q(c)}" for c, tags in CHUNK_OF_POS.items()
)
CHUNKED = f"chunked AS (SELECT *, CASE {_CLASSES} ELSE 'O' END AS chunk FROM possed)"
CHUNKS = f"""{CHUNKED}, {runs('chunked', 'chunk', 'phrases', commas=False)},
  bracketed AS (SELECT doc_id, sentence_id, string_agg('(' || tag || ' ' || mention || ')', ' ' ORDER BY first) AS parse_sentence
                FROM phrases GROUP BY doc_id, sentence_id)"""

GROUPED = """grouped AS (
    SELECT doc_id, sentence_id, string_agg('(' || tag || ',' || m || ')', ',' ORDER BY tag) AS ner FROM (
      SELECT doc_id, sentence_id, tag, string_agg(mention, '|' ORDER BY first) AS m FROM spans
      GROUP BY doc_id, sentence_id, tag) GROUP BY doc_id, sentence_id)"""

PAIRS = """ahead AS (
    SELECT *, lead(tag) OVER w AS tag2, lead(mention) OVER w AS mention2, lead(first) OVER w AS first2 FROM spans
    WINDOW w AS (PARTITION BY doc_id, sentence_id ORDER BY first)),
  pairs AS (
    SELECT a.doc_id, a.sentence_id, a.first, a.tag AS type1, a.mention AS mention1, a.tag2 AS type2, a.mention2,
           coalesce((SELECT string_agg(t.token, ' ' ORDER BY t.idx) FROM toks t
                     WHERE t.doc_id = a.doc_id AND t.sentence_id = a.sentence_id
                       AND t.idx > a.last AND t.idx < a.first2), '') AS connector
    FROM ahead a WHERE tag2 IS NOT NULL)"""

SENTIMENT = """felt AS (
    SELECT t.doc_id, t.sentence_id,
           (2 + least(greatest(coalesce(sum(p.weight::BIGINT), 0), -2), 2))::BIGINT AS sentiment
    FROM toks t LEFT JOIN pol p ON p.language = t.language AND p.word = lower(t.token)
    GROUP BY t.doc_id, t.sentence_id)"""

# --- Arabic route -----------------------------------------------------------

_AR = f"translate(lower(text), {q(LATIN)}, {q(ARABIC)})"
_AR_LINES = f"string_split({_AR}, chr(10))"
# Pieces keep their blanks when already ended; the first carries the same two.
_AR_PIECE = (
    f"(CASE WHEN {jt('p')} = '' OR ends_with({jt('p')}, '.') THEN '  ' || p || ' ' ELSE {jt('p')} || '.' END)"
)
AR_STORIES = f"""stories AS (
  SELECT 'D' || doc_id AS doc_id, 'ARA' AS language,
         array_to_string(list_transform({_AR_LINES}, lambda p: {_AR_PIECE}), '') || '  ' AS body
  FROM documents)"""
AR_SENTS = f"""sents AS (
  SELECT doc_id, language, unnest(s) AS sentence, generate_subscripts(s, 1)::BIGINT AS sentence_id FROM (
    SELECT doc_id, language, list_filter(list_transform(string_split(body, '.'), lambda s: {jt('s')}), lambda s: s <> '') AS s
    FROM stories))"""


def arabic_norm(x: str) -> str:
    out = f"translate({x}, {q(DIGITS_FROM + ALIF_FROM + YA_FROM)}, {q(DIGITS_TO + ALIF_TO + YA_TO)})"
    out = f"regexp_replace({out}, {q(DIACRITICS)}, '', 'g')"
    out = f"replace({out}, {q(TATWEEL)}, '')"
    out = f"regexp_replace({out}, {q(PRO_MARKER)}, '', 'g')"
    out = f"regexp_replace({out}, {q(SEGMENT_MARKER)}, '\\1\\2', 'g')"
    out = f"replace({out}, '+', '')"
    for letter in sorted({c for c in ARABIC if "ء" <= c <= "ي"} | {"ا", "ي"}):
        out = f"regexp_replace({out}, {q(letter + '{3,}')}, {q(letter)}, 'g')"
    return out


def arabic_tokens(x: str) -> str:
    return (
        f"list_transform({tokens_of(arabic_norm(x))}, "
        "lambda t: CASE t WHEN '(' THEN '-LRB-' WHEN ')' THEN '-RRB-' ELSE t END)"
    )


def rule_case(token: str) -> str:
    folded: dict[str, list[str]] = {}
    for pattern, tag in RULES:
        folded.setdefault(tag, []).append(pattern)
    return "CASE " + " ".join(
        f"WHEN regexp_matches({token}, {q('^(?:' + '|'.join(ps) + ')$')}) THEN {q(tag)}" for tag, ps in folded.items()
    ) + " ELSE 'O' END"


def plain_text(x: str) -> str:
    out = f"regexp_replace({x}, {q(MARKUP)}, ' ', 'g')"
    for name, char in ENTITIES:
        out = f"replace({out}, {q(name)}, {q(char)})"
    return jt(f"regexp_replace({out}, '\\s+', ' ', 'g')")


BROKEN = f"""CASE
  WHEN doc_id % 25 = 19 THEN 'blank'
  WHEN doc_id % 25 = 17 THEN 'not_doc'
  WHEN doc_id % 25 = 3 THEN 'no_text'
  WHEN doc_id % 25 = 11 THEN 'bad_dateline'
  WHEN doc_id % 25 = 7 THEN 'bad_headline'
  WHEN doc_id % 25 = 13 THEN 'no_id'
  WHEN NOT ({STORY}) THEN 'not_story'
  WHEN ({OWN_LANG}) IS NULL THEN 'bad_lang' END"""

# In a stream an id is not asked for, and every message has the language of its job.
STREAM_BROKEN = "\n".join(
    line + (" END" if "not_story" in line else "")
    for line in BROKEN.split("\n") if "no_id" not in line and "bad_lang" not in line
)

WORDS_OF = (
    "(CASE WHEN {x} <> '' AND rtrim({x}, ' ') = '' THEN [] ELSE string_split(rtrim({x}, ' '), ' ') END)"
)


def words_of(x: str) -> str:
    return WORDS_OF.replace("{x}", x)


def build() -> dict[str, str]:
    sql: dict[str, str] = {}

    # Sources.
    sql["scan_nonblank"] = f"""
      SELECT value, count(*) AS n FROM (SELECT unnest({LINES}) AS value FROM documents)
      WHERE {jt('value')} <> '' GROUP BY value"""
    sql["file_listing"] = f"""
      SELECT 'lang=' || lang AS folder, sum(strlen(text) + 1)::BIGINT AS n_bytes, sum(len({LINES}))::BIGINT AS n_lines
      FROM documents GROUP BY lang"""
    sql["first_file"] = f"SELECT 'D' || doc_id AS doc_id, md5({BODY}) AS body_md5 FROM documents WHERE lang = 'en'"
    xml = f"""SELECT 'D' || doc_id AS doc_id, {PLAIN_KIND} AS type, {HEAD} AS head_line, {DATE} AS date_line,
      len(list_filter({LINES}, lambda p: {jt('p')} <> ''))::BIGINT AS n_paragraphs, md5({BODY_XML}) AS body_md5 FROM documents"""
    sql["docs_xml"] = xml
    sql["docs_xml_lines"] = xml
    sql["xml_paragraphs"] = f"""
      SELECT 'D' || doc_id AS doc_id, generate_subscripts(l, 1)::BIGINT AS sentence_id, {jt('unnest(l)')} AS sentence
      FROM (SELECT doc_id, {LINES} AS l FROM documents)"""
    sql["docs_tagged"] = f"""
      SELECT 'A' || doc_id AS doc_id, 1::BIGINT AS doc_pos, md5({BODY}) AS body_md5 FROM documents
      UNION ALL
      SELECT 'B' || doc_id, 2::BIGINT, md5({finish('replace(text, chr(10), chr(32))')} || ' ') FROM documents"""
    sql["docs_tag_files"] = f"""
      SELECT 'D' || doc_id AS doc_id, md5({BODY}) AS body_md5 FROM documents"""
    sql["docs_tag_splits"] = sql["stream_tag_files"] = sql["docs_tag_files"]
    sql["docs_json"] = f"""
      SELECT 'D' || doc_id AS doc_id, {KIND} AS type, coalesce({OWN_LANG}, upper(lang)) AS language,
             len({sentences_of('text')})::BIGINT AS n_sentences,
             CASE WHEN ({OWN_LANG}) IS NULL THEN 'bad_lang' END AS reason FROM documents"""
    sql["docs_json_open"] = f"""
      SELECT 'D' || doc_id AS doc_id, coalesce({OWN_LANG}, upper(lang)) AS language, CASE WHEN ({OWN_LANG}) IS NULL THEN 'bad_lang' END AS reason,
        len({LINES})::BIGINT AS n_lines, CASE WHEN doc_id % 2 = 0 THEN source END AS tag, CASE WHEN doc_id % 2 = 0 THEN n_chars::BIGINT END AS n_chars,
        CASE WHEN doc_id % 6 = 0 THEN doc_id::DOUBLE WHEN doc_id % 2 <> 0 AND doc_id % 3 = 0 THEN doc_id::DOUBLE / 4 END AS rank FROM documents"""
    sql["user_records"] = """
      SELECT c_custkey::VARCHAR AS account, c_name AS name,
             CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey::BIGINT END AS number FROM customer"""
    sql["memory_lines"] = f"""
      SELECT word, count(*) AS n FROM (SELECT unnest(string_split('story STORY multi other multi', ' ')) AS word) k
      JOIN (SELECT {KIND} AS kind FROM documents) d ON k.word = d.kind
      GROUP BY word"""

    # Parsing.
    sql["doc_header"] = f"""
      SELECT 'D' || doc_id AS doc_id, {KIND} AS type, {HEAD} AS head_line, {DATE} AS date_line, {OWN_LANG} AS language FROM documents"""
    sql["doc_body"] = f"""
      SELECT 'D' || doc_id AS doc_id, len(list_filter({LINES}, lambda p: {jt('p')} <> ''))::BIGINT AS n_paragraphs,
             {BODY} AS body FROM documents WHERE {STORY}"""
    sql["doc_routing"] = f"""
      SELECT coalesce({OWN_LANG}, 'none') AS language, CASE WHEN NOT ({STORY}) THEN 'not_story' WHEN ({OWN_LANG}) IS NULL THEN 'bad_lang' ELSE 'ok' END AS outcome,
             count(*) AS n FROM documents GROUP BY ALL"""
    sql["dead_letters"] = f"""
      SELECT doc_id AS key, reason FROM (SELECT doc_id, {BROKEN} AS reason FROM documents)
      WHERE reason NOT IN ('blank', 'not_story')"""
    sql["extract_field"] = """
      SELECT page_id, regexp_extract(replace(html, chr(10), ' '), '(?s)<title>(.*?)</title>', 1) AS title FROM pages"""
    bodies = f"bodies AS (SELECT source, doc_id, {BODY} AS body FROM documents)"
    sql["corpus_concat"] = f"""WITH {bodies}
      SELECT source, doc_id AS position, md5(body) AS body_md5, strlen(body)::BIGINT AS length,
        coalesce(sum(strlen(body)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
      FROM bodies"""
    sql["corpus_digests"] = f"""WITH {bodies},
      whole AS (SELECT source, encode(string_agg(body, '' ORDER BY doc_id)) AS t FROM bodies GROUP BY source),
      cut AS (SELECT source, t, unnest(range((octet_length(t) + 99999) // 100000)) AS block FROM whole)
      SELECT source, block, octet_length(t[block * 100000 + 1 : block * 100000 + 100000])::BIGINT AS n_bytes,
        sha256(t[block * 100000 + 1 : block * 100000 + 100000]) AS sha256 FROM cut"""
    sql["envelope"] = f"""
      SELECT CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'M' || doc_id END AS mongo_id, 'D' || doc_id AS doc_id, md5({BODY}) AS body_md5
      FROM documents"""
    sql["doc_json"] = f"""
      SELECT 'M' || doc_id AS mongo_id, 'D' || doc_id AS doc_id, {PLAIN_KIND} AS type, {LANG} AS language, {HEAD} AS head_line,
             md5({BODY}) AS body_md5 FROM documents"""

    # Word counts.
    words = f"""SELECT word, count(*) AS count FROM (SELECT unnest({words_of('body')}) AS word FROM stories) GROUP BY word"""
    sql["word_count"] = f"WITH {STORIES} {words}"
    sql["word_count_doc"] = f"WITH {STORIES} SELECT word, count::VARCHAR AS count FROM ({words})"
    sql["top_words"] = f"WITH {STORIES} SELECT * FROM ({words}) ORDER BY count DESC, word LIMIT 10"
    sql["threshold_count"] = "SELECT count(*) AS n FROM orders WHERE o_orderkey < 10000"

    # Sentences and tokens.
    sql["sentences"] = f"WITH {STORIES}, {SENTS} SELECT doc_id, language, sentence_id, sentence FROM sents"
    sql["first_sentence"] = f"WITH {STORIES}, {SENTS} SELECT doc_id, sentence FROM sents WHERE sentence_id = 1"
    def edges(x: str) -> str:
        return f"regexp_replace(regexp_replace({x}, {q(OPENERS)}, ''), {q(CLOSERS)}, '')"

    learned = f"""bare AS (SELECT {edges('w')} AS w FROM (SELECT unnest(regexp_split_to_array(body, '\\s+')) AS w FROM stories)),
      types AS (SELECT word, count(*) FILTER (ends) AS dotted, count(*) FILTER (NOT ends) AS plain FROM (
        SELECT ends_with(w, '.') AS ends, lower(CASE WHEN ends THEN left(w, length(w) - 1) ELSE w END) AS word FROM bare)
        WHERE regexp_matches(word, {q(TYPE)}) GROUP BY word),
      base AS (SELECT sum(dotted) / sum(dotted + plain) AS p FROM types),
      known AS (SELECT word, dotted, plain FROM (
        SELECT *, -2 * (dotted * ln(p) + plain * ln(1 - p) - dotted * ln({SHARE}) - plain * ln(1 - {SHARE})) AS ratio,
          length(replace(word, '.', '')) AS letters FROM types, base WHERE p > 0 AND p < 1)
        WHERE dotted > 0 AND ratio * exp(-letters) * (length(word) - letters + 1) * pow(letters::DOUBLE, -plain::DOUBLE) >= {LIMIT})"""
    sql["abbreviations"] = f"WITH {STORIES}, {learned} SELECT * FROM known"
    sql["sentences_learned"] = f"""WITH {STORIES}, {learned},
      pieces AS (SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS piece FROM (
        SELECT doc_id, string_split(regexp_replace(body, {q(CANDIDATE)}, '\\1' || chr(1) || '\\2', 'g'), chr(1)) AS l FROM stories)),
      closed AS (SELECT doc_id, string_agg(CASE WHEN k.word IS NULL THEN piece || chr(1) ELSE piece END, '' ORDER BY i) AS t
        FROM pieces LEFT JOIN known k ON k.word = lower(regexp_extract(piece, {q(LAST_WORD)}, 1)) GROUP BY doc_id),
      lists AS (SELECT doc_id, list_filter(list_transform(string_split(t, chr(1)), lambda s: {jt('s')}), lambda s: s <> '') AS l FROM closed)
      SELECT doc_id, unnest(l) AS sentence, generate_subscripts(l, 1)::BIGINT AS sentence_id FROM lists"""
    sql["arabic_sentences"] = f"WITH {AR_STORIES}, {AR_SENTS} SELECT doc_id, sentence_id, sentence FROM sents"
    sql["arabic_norm"] = f"""WITH {AR_STORIES}, {AR_SENTS}
      SELECT doc_id, sentence_id, array_to_string({arabic_tokens('sentence')}, ',') AS token FROM sents"""
    sql["tokens"] = f"""WITH {STORIES}, {SENTS}
      SELECT doc_id, sentence_id, len(t)::BIGINT AS n_tokens, array_to_string(t, ',') AS token
      FROM (SELECT *, {tokens_of('sentence')} AS t FROM sents)"""
    sql["long_sentences"] = f"""WITH {STORIES}, {SENTS}
      SELECT doc_id, sentence_id, len({tokens_of('sentence')})::BIGINT AS n_tokens FROM sents WHERE len({tokens_of('sentence')}) > 140"""

    # Lexicon annotations.
    def joined(source: str, column: str) -> str:
        return f"""SELECT doc_id, sentence_id, string_agg({column}, ',' ORDER BY idx) AS {column}
          FROM {source} GROUP BY doc_id, sentence_id"""

    sql["lemmas"] = f"WITH {LEMMA_CTE}, {TO_TOKENS}, {LEMMAED} {joined('lemmaed', 'lemma')}"
    sql["pos_tags"] = f"WITH {POS_CTE}, {TO_TOKENS}, {POSSED} {joined('possed', 'pos')}"
    sql["entity_tags"] = f"WITH {GAZ_CTE}, {TO_TOKENS}, {TAGGED} {joined('tagged', 'ner')}"
    # All words and word pairs of all messages.
    said = f"""said AS (SELECT role, w, generate_subscripts(w, 1) AS i FROM (
        SELECT role, list_transform({tokens_of('text')}, lambda t: lower(t)) AS w FROM conversations)),
      texts AS (SELECT DISTINCT unnest(['ENG', 'ESP']) AS language, phrase, role FROM (
        SELECT w[i] AS phrase, role FROM said UNION ALL SELECT w[i] || ' ' || w[i + 1], role FROM said WHERE i < len(w)))"""
    sql["entity_tags_joined"] = f"""WITH {TO_TOKENS}, {said},
      gaz AS (SELECT language, phrase, min(role) AS ner FROM texts GROUP BY ALL),
      {gazetteer_tags('gaz', 2)}
      SELECT doc_id, ner, count(*) AS n FROM tagged WHERE ner <> 'O' GROUP BY doc_id, ner"""
    sql["regex_entities"] = f"""WITH {TO_TOKENS}
      SELECT ner, token, count(*) AS n FROM (SELECT token, {rule_case('token')} AS ner FROM toks) WHERE ner <> 'O' GROUP BY ALL"""
    sql["sentiment"] = f"WITH {POL_CTE}, {TO_TOKENS}, {SENTIMENT} SELECT doc_id, sentence_id, sentiment FROM felt"
    sql["truecase"] = f"""WITH {TO_TOKENS},
      casing AS (SELECT word, cased FROM (SELECT lower(token) AS word, token AS cased, row_number() OVER (PARTITION BY lower(token) ORDER BY count(*) DESC, token DESC) AS rn
                 FROM toks GROUP BY token) WHERE rn = 1)
      SELECT doc_id, count(*) AS n_tokens, count(*) FILTER (token <> cased) AS n_changed
      FROM toks JOIN casing ON lower(token) = word GROUP BY doc_id"""
    sql["casing_model"] = f"""WITH {TO_TOKENS}
      SELECT word, cased, n FROM (SELECT lower(token) AS word, token AS cased, count(*) AS n, row_number() OVER (PARTITION BY lower(token) ORDER BY count(*) DESC, token DESC) AS rn
                 FROM toks GROUP BY token) WHERE rn = 1"""
    sql["clean_markup"] = f"SELECT page_id, {plain_text('html')} AS text FROM pages"

    # Entities.
    sql["entity_groups"] = f"""WITH {GAZ_CTE}, {TO_TOKENS}, {TAGGED}
      SELECT doc_id, sentence_id, string_agg('(' || ner || ',' || m || ')', ',' ORDER BY ner) AS ner FROM (
        SELECT doc_id, sentence_id, ner, string_agg(token, '|' ORDER BY idx) AS m FROM tagged WHERE ner <> 'O' GROUP BY doc_id, sentence_id, ner)
      GROUP BY doc_id, sentence_id"""
    sql["entity_spans"] = f"WITH {TO_SPANS} SELECT doc_id, sentence_id, tag AS ner, first, last, mention FROM spans"
    sql["entity_spans_windowed"] = sql["entity_spans"]
    sql["mention_groups"] = f"""WITH {TO_SPANS}
      SELECT doc_id, sentence_id, tag AS ner, string_agg(mention, '|' ORDER BY first) AS mentions FROM spans GROUP BY ALL"""
    sql["chunks"] = f"WITH {POS_CTE}, {TO_TOKENS}, {POSSED}, {CHUNKS} SELECT doc_id, sentence_id, parse_sentence FROM bracketed"
    aliases = """firsts AS (SELECT doc_id, tag AS ner, mention, min(sentence_id) AS position FROM spans GROUP BY ALL),
      linked AS (SELECT m.doc_id, m.ner, m.mention,
        first(c.mention ORDER BY length(c.mention) DESC, c.position, c.mention DESC) AS canonical
      FROM firsts m JOIN firsts c ON c.doc_id = m.doc_id AND c.ner = m.ner
        AND (c.mention = m.mention OR ends_with(c.mention, ' ' || m.mention)) GROUP BY m.doc_id, m.ner, m.mention)"""
    sql["aliases"] = f"WITH {TO_SPANS}, {aliases} SELECT * FROM linked"
    sql["relations"] = f"""WITH {TO_SPANS}, {PAIRS}
      SELECT type1, connector, type2, count(*) AS n FROM pairs GROUP BY ALL"""

    def learned_round(n: int) -> str:
        """Patterns trusted by the pairs of the round before, and the pairs believed by them."""
        return f"""patterns{n} AS (SELECT * FROM (
        SELECT type1, connector, type2, count(k.mention1) AS known, count(k.mention1) / count(*) AS confidence
        FROM facts f LEFT JOIN known{n - 1} k ON k.mention1 = f.mention1 AND k.mention2 = f.mention2 GROUP BY ALL)
        WHERE known >= 2 AND confidence >= 0.3),
      believed{n} AS (SELECT * FROM (SELECT mention1, mention2, 1 - product(1 - confidence) AS score
        FROM facts JOIN patterns{n} USING (type1, connector, type2) GROUP BY ALL) WHERE score >= 0.4),
      known{n} AS (SELECT mention1, mention2, CASE WHEN k.round = 0 THEN k.score ELSE coalesce(b.score, k.score) END AS score, coalesce(k.round, {n}) AS round
        FROM known{n - 1} k FULL JOIN believed{n} b USING (mention1, mention2))"""

    sql["relations_learned"] = f"""WITH {TO_SPANS}, {PAIRS},
      facts AS (SELECT type1, connector, type2, mention1, mention2, count(*) AS n FROM pairs GROUP BY ALL),
      known0 AS (SELECT mention1, mention2, 1.0::DOUBLE AS score, 0 AS round FROM facts GROUP BY ALL HAVING sum(n) > 2),
      {learned_round(1)}, {learned_round(2)}
      SELECT mention1, mention2, round(score, 6) AS score, round FROM known2"""

    # Documents.
    def whole(lexicons: str, tagged: str = TAGGED) -> str:
        return f"""{lexicons}, {TO_ROUTED_TOKENS}, {LEMMAED}, {POSSED}, {tagged}, {SPANS}, {GROUPED},
      flat AS (SELECT doc_id, sentence_id, string_agg('(' || ner || ',' || m || ')', ',' ORDER BY ner) AS ner FROM (
        SELECT doc_id, sentence_id, ner, string_agg(token, '|' ORDER BY idx) AS m FROM tagged WHERE ner <> 'O' GROUP BY doc_id, sentence_id, ner)
      GROUP BY doc_id, sentence_id), {PAIRS},
      rel AS (SELECT doc_id, sentence_id, string_agg(type1 || '(' || mention1 || ') ' || connector || ' ' || type2 || '(' || mention2 || ')', '; ' ORDER BY first) AS relation
              FROM pairs GROUP BY ALL),
      {CHUNKS}, {SENTIMENT},
      lem AS (SELECT doc_id, sentence_id, string_agg(token, ',' ORDER BY idx) AS token, string_agg(lemma, ',' ORDER BY idx) AS lemma, count(*) AS n
              FROM lemmaed GROUP BY ALL),
      docs AS (SELECT s.doc_id, s.language, s.sentence_id, s.sentence, l.token, l.lemma, l.n,
          CASE s.language WHEN 'ENG' THEN coalesce(g.ner, '') ELSE coalesce(f.ner, '') END AS ner,
          coalesce(r.relation, '') AS relation,
          CASE s.language WHEN 'ENG' THEN e.sentiment END AS sentiment,
          coalesce(b.parse_sentence, '') AS parse_sentence
        FROM sents s JOIN lem l USING (doc_id, sentence_id) JOIN felt e USING (doc_id, sentence_id)
        LEFT JOIN grouped g USING (doc_id, sentence_id) LEFT JOIN flat f USING (doc_id, sentence_id)
        LEFT JOIN rel r USING (doc_id, sentence_id) LEFT JOIN bracketed b USING (doc_id, sentence_id))"""
    fixed = f"{LEMMA_CTE}, {POS_CTE}, {GAZ_CTE}, {POL_CTE}"
    sql["documents_assembled"] = f"""WITH {whole(fixed)}
      SELECT d.doc_id, s.type, s.head_line, s.date_line, d.language, d.sentence_id, d.sentence, d.token, d.lemma, d.ner, d.relation, d.sentiment, d.parse_sentence
      FROM docs d JOIN stories s USING (doc_id)"""
    sql["documents_selected"] = f"""WITH {whole(fixed)}
      SELECT doc_id, language, sentence_id, NULL AS token, NULL AS lemma, ner, NULL AS relation, sentiment, NULL AS parse_sentence FROM docs"""
    derived = f"""{said},
      words AS (SELECT DISTINCT language, phrase AS word FROM texts WHERE NOT contains(phrase, ' ')),
      lemma_lex AS (SELECT language, word, left(word, 4) AS lemma FROM words),
      pos_lex AS (SELECT language, word, CASE length(word) % 3 WHEN 0 THEN 'VB' WHEN 1 THEN 'NN' ELSE 'IN' END AS pos FROM words),
      pol AS (SELECT language, word, (length(word) % 3 - 1)::VARCHAR AS weight FROM words),
      gaz AS (SELECT language, phrase, upper(min(role)) AS ner FROM texts GROUP BY ALL)"""
    sql["documents_tables"] = f"""WITH {whole(derived, gazetteer_tags('gaz', 2))}
      SELECT doc_id, language, sentence_id, token, lemma, ner, sentiment, parse_sentence FROM docs"""
    sql["documents_regrouped"] = f"""WITH {TO_TOKENS}
      SELECT doc_id, max(sentence_id) AS n_sentences, count(*) AS n_tokens FROM toks GROUP BY doc_id"""
    sql["documents_coref"] = f"""WITH {TO_SPANS}, {aliases},
      found AS (SELECT doc_id, string_agg(ner || ': ' || mention || ' -> ' || canonical, '; ' ORDER BY ner || ': ' || mention || ' -> ' || canonical) AS corref
      FROM linked WHERE mention <> canonical GROUP BY doc_id)
      SELECT s.doc_id, CASE WHEN s.language = 'ENG' THEN f.corref END AS corref FROM stories s LEFT JOIN found f USING (doc_id)"""
    agreeing = ", ".join(f"({q(w)}, {q(t)})" for w, types in PRONOUNS.items() for t in types)
    sql["documents_links"] = f"""WITH {TO_SPANS},
      said AS (SELECT doc_id, sentence_id, tag AS ner, mention, string_split(mention, ' ') AS w FROM spans WHERE language = 'ENG'),
      offered AS (SELECT doc_id, ner, mention, sentence_id, 'exact' AS sieve, lower(mention) AS key FROM said
        UNION ALL SELECT doc_id, ner, mention, sentence_id, 'head', lower(array_to_string(list_slice(w, i, len(w)), ' ')) FROM (
          SELECT *, unnest(range(2, len(w) + 1)) AS i FROM said)
        UNION ALL SELECT doc_id, ner, mention, sentence_id, 'acronym', lower(initials) FROM (
          SELECT *, array_to_string(list_transform(w, lambda x: left(x, 1)), '') AS initials FROM said)
          WHERE len(w) > 1 AND regexp_matches(initials, '^\\p{{Lu}}+$')),
      longest AS (SELECT doc_id, ner, key, mention AS canonical, sieve FROM offered
        QUALIFY row_number() OVER (PARTITION BY doc_id, ner, key ORDER BY length(mention) DESC, sentence_id, mention DESC, sieve DESC) = 1),
      links AS (SELECT s.doc_id, s.sentence_id, s.ner, s.mention, b.canonical, CASE WHEN s.mention = b.canonical THEN 'self' ELSE b.sieve END AS sieve
        FROM said s JOIN longest b ON b.doc_id = s.doc_id AND b.ner = s.ner AND b.key = lower(s.mention)),
      agrees(word, ner) AS (VALUES {agreeing}),
      meant AS (SELECT t.doc_id, t.sentence_id, t.idx, t.token, l.ner, l.canonical FROM toks t JOIN agrees a ON a.word = lower(t.token)
        JOIN links l ON l.doc_id = t.doc_id AND l.ner = a.ner AND l.sentence_id < t.sentence_id
        QUALIFY row_number() OVER (PARTITION BY t.doc_id, t.sentence_id, t.idx ORDER BY l.sentence_id DESC, l.ner DESC, l.canonical DESC) = 1)
      SELECT * FROM links UNION ALL SELECT doc_id, sentence_id, ner, token AS mention, canonical, 'pronoun' FROM meant"""
    ar_profile = AR_SENTS.replace("sents AS", "ar_sents AS").replace("FROM stories", "FROM ar_stories")
    ar_stories = AR_STORIES.replace("stories AS", "ar_stories AS").replace("FROM documents)", "FROM documents WHERE lang = 'de')")
    own_stories = stories_of(PLAIN_KIND, "lang <> 'de'")
    sql["profile_columns"] = f"""WITH {own_stories}, {SENTS}, {ar_stories}, {ar_profile},
      every AS (SELECT language, len({tokens_of('sentence')}) AS n FROM sents
                UNION ALL SELECT language, len({arabic_tokens('sentence')}) FROM ar_sents)
      SELECT language, count(*) AS n_sentences,
        count(*) FILTER (language <> 'ARA') AS with_lemma, count(*) FILTER (language <> 'ARA') AS with_ner,
        count(*) FILTER (language = 'ENG') AS with_sentiment, count(*) AS with_parse, 0::BIGINT AS with_dependency
      FROM every GROUP BY language"""
    sql["run_metrics"] = f"""
      SELECT count(*) AS records, count(*) FILTER (reason IS NULL) AS good,
        count(*) FILTER (reason IN ('blank', 'not_story')) AS dropped,
        count(*) FILTER (reason NOT IN ('blank', 'not_story')) AS failed FROM (SELECT {BROKEN} AS reason FROM documents)"""

    # Store.
    sizes = f"""SELECT doc_id, max(sentence_id) AS n_sentences, count(*) AS n_tokens FROM toks GROUP BY doc_id"""
    sql["store_append"] = f"WITH {TO_ROUTED_TOKENS} {sizes}"
    sql["sentence_store"] = f"""WITH {POS_CTE}, {TO_TOKENS}, {POSSED}, {CHUNKS},
      n AS (SELECT doc_id, sentence_id, count(*) AS n FROM toks GROUP BY ALL)
      SELECT sentence, parse, count(*) AS n FROM (
        SELECT s.sentence, coalesce(b.parse_sentence, '') AS parse FROM sents s LEFT JOIN bracketed b USING (doc_id, sentence_id))
      GROUP BY ALL"""
    version = "CASE WHEN lang = 'es' THEN 'third' WHEN source = 'src1' THEN 'second, late' ELSE 'first' END"
    sql["store_upsert"] = f"""
      SELECT 'D' || doc_id AS doc_id, {version} AS version, md5({BODY}) AS body_md5 FROM documents"""
    sql["store_two_runs"] = sql["store_upsert"].replace("second, late", "second")
    sql["store_lookup"] = """
      SELECT 'D' || d.doc_id AS doc_id, CASE WHEN d.lang = 'es' THEN 'second' ELSE 'first' END AS version
      FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels)"""
    sql["skip_existing"] = f"""
      SELECT 'D' || doc_id AS doc_id, {LANG} AS language FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)"""
    sql["store_lookup_indexed"] = f"""
      SELECT 'D' || doc_id AS doc_id, CASE WHEN source = 'src1' THEN 'third' WHEN lang = 'es' THEN 'second' ELSE 'first' END AS version,
             md5({BODY}) AS body_md5
      FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"""
    sql["skip_stored"] = sql["skip_existing"]

    # Streams.
    sql["stream_docs"] = f"""WITH {TO_ROUTED_TOKENS}
      SELECT doc_id, 'M' || substr(doc_id, 2) AS mongo_id, max(sentence_id) AS n_sentences, count(*) AS n_tokens
      FROM toks GROUP BY doc_id"""
    sql["stream_dead_letters"] = f"""
      SELECT 'M' || doc_id AS key, reason FROM (SELECT doc_id, {STREAM_BROKEN} AS reason FROM documents)
      WHERE reason NOT IN ('blank', 'not_story')"""
    # Text before a record is only log text in a message.
    sql["stream_published"] = f"""
      SELECT 'M' || doc_id AS key, coalesce(reason, 'published') AS outcome FROM (
        SELECT doc_id, {STREAM_BROKEN} AS r, CASE WHEN r = 'not_doc' THEN CASE WHEN NOT ({STORY}) THEN 'not_story' END ELSE r END AS reason
        FROM documents)
      WHERE coalesce(reason, '') NOT IN ('blank', 'not_story')"""
    sql["stream_glued"] = f"""WITH {TO_TOKENS},
      each AS ({sizes}), halves AS (SELECT unnest(['A', 'B']) AS half, unnest([1, 2])::BIGINT AS doc_pos)
      SELECT half || substr(doc_id, 2) AS doc_id, 'M' || substr(doc_id, 2) AS mongo_id, doc_pos, n_sentences, n_tokens
      FROM each, halves"""
    sql["stream_json_sink"] = f"""WITH {TO_ROUTED_TOKENS}
      SELECT doc_id, 'M' || substr(doc_id, 2) AS mongo_id, sentence_id, string_agg(token, ',' ORDER BY idx) AS token
      FROM toks GROUP BY doc_id, sentence_id"""
    sql["stream_word_count"] = f"""
      SELECT word, count(*) AS count FROM (SELECT unnest({words_of('text')}) AS word FROM documents) GROUP BY word"""
    sql["stream_window_count"] = """
      SELECT to_timestamp(floor(epoch(ts) / 1800) * 1800)::TIMESTAMP AS window_start, event_type AS word, count(*) AS count
      FROM events GROUP BY ALL"""
    sql["stream_window_late"] = """
      WITH dealt AS (SELECT event_type AS word, ts, to_timestamp(floor(epoch(ts) / 1800) * 1800)::TIMESTAMP AS window_start,
          CASE WHEN event_id % 5 = 0 THEN 2 WHEN epoch_us(ts) < ((SELECT min(epoch_us(ts)) + max(epoch_us(ts)) FROM events) / 2)::BIGINT THEN 0 ELSE 1 END AS b
        FROM events),
      marks AS (SELECT b, max(max(ts)) OVER (ORDER BY b) - INTERVAL 6 HOUR AS after FROM dealt GROUP BY b),
      judged AS (SELECT d.*, CASE WHEN window_start + INTERVAL 30 MINUTE <= m.after THEN 'late'
          WHEN window_start + INTERVAL 30 MINUTE <= (SELECT max(after) FROM marks) THEN 'emitted' ELSE 'open' END AS kind
        FROM dealt d LEFT JOIN marks m ON m.b = d.b - 1)
      SELECT kind, window_start, word, count(*) AS count FROM judged GROUP BY ALL"""
    sql["batch_window_count"] = sql["stream_window_count"]
    sql["stream_topics"] = f"""
      SELECT topic, count(*) AS n_messages, sum(n)::BIGINT AS n_words FROM (
        SELECT 'documents' AS topic, len({words_of('text')}) AS n FROM documents
        UNION ALL SELECT 'conversations', len({words_of('text')}) FROM conversations) GROUP BY topic"""

    # Plug-in annotators.
    sql["bulk_annotate"] = f"""
      SELECT doc_id, len({tokens_of('text')})::BIGINT AS n_tokens,
             CASE WHEN doc_id % 10 = 0 THEN NULL ELSE length(text)::BIGINT END AS n_chars,
             (CASE WHEN doc_id % 10 = 0 THEN 1 ELSE 0 END)::BIGINT AS n_errors FROM documents"""
    turns = f"count(*) AS n_turns, sum(len({tokens_of('text')}))::BIGINT AS n_tokens"
    sql["worker_singleton"] = f"SELECT {turns}, TRUE AS shared FROM conversations"
    sql["task_instance"] = f"SELECT {turns}, TRUE AS apart FROM conversations"
    return sql
