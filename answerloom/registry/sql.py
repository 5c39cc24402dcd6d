"""SQL fragments shared by the oracles: named CTEs, put together by ``with_``.

They restate the definitions independently of the Spark code, over whole tables.
"""

from __future__ import annotations


def clean(x: str) -> str:
    return (f"replace(replace(replace(replace({x}, '\\n\\n', ' '), chr(10) || chr(10), ' '), "
            f"'\\n', ' '), chr(10), ' ')")


GAP = r"([.!?])[\t\n\x0B\f\r ]+"
SPACES = r"[\x09-\x0D\x1C-\x1F\x{85}\p{Z}]+"
PUNCT = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"


def canonical(x: str) -> str:
    return rf"regexp_replace(replace({clean(x)}, chr(30), ' '), '{GAP}', '\1 ', 'g')"


def sentence_list(x: str) -> str:
    return (rf"string_split(regexp_replace(replace({clean(x)}, chr(30), ' '), '{GAP}', "
            rf"'\1' || chr(30), 'g'), chr(30))")


def words(x: str) -> str:
    return rf"list_filter(string_split_regex(lower({x}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"


def normalized(x: str) -> str:
    """Word borders spelled out: marks around every other character make them visible."""
    bare = f"translate(lower({x}), '{PUNCT}', '')"
    marked = rf"regexp_replace({bare}, '([^\p{{L}}\p{{N}}_])', chr(30) || '\1' || chr(30), 'g')"
    cut = rf"regexp_replace({marked}, '(^|\x1e)(a|an|the)(\x1e|$)', '\1 \3', 'g')"
    return f"trim(regexp_replace(replace({cut}, chr(30), ''), '{SPACES}', ' ', 'g'))"


def answer_tokens(x: str) -> str:
    return f"list_filter(string_split({normalized(x)}, ' '), lambda t: t <> '')"


def hash_number(seed: int, x: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}-' || {x}), 1, 7) AS BIGINT)"


def in_test(fraction: float, seed: int, x: str) -> str:
    return f"{hash_number(seed, x)} < {int(round(fraction * (1 << 28)))}"


def chunks(name: str, source: str, keys: str, limit: int = 470) -> dict[str, str]:
    """CTEs that cut ``source`` (keys, text) into ``name`` (keys, paragraph_id, start, text)."""
    first = keys.split(",")[0].strip()
    fits = f"length(p.cur) + 1 + length(s.s) <= {limit}"
    return {
        f"{name}_list": f"SELECT {keys}, {sentence_list('text')} AS s FROM {source}",
        f"{name}_sent": f"SELECT {first}, unnest(s) AS s, "
                        f"generate_subscripts(s, 1) AS i FROM {name}_list",
        f"{name}_pack": f"""
            SELECT {first}, 1 AS i, s AS cur, 0 AS start, 0 AS no FROM {name}_sent WHERE i = 1
            UNION ALL
            SELECT p.{first}, s.i,
                   CASE WHEN {fits} THEN p.cur || ' ' || s.s ELSE s.s END,
                   CASE WHEN {fits} THEN p.start ELSE p.start + length(p.cur) + 1 END,
                   CASE WHEN {fits} THEN p.no ELSE p.no + 1 END
            FROM {name}_pack p JOIN {name}_sent s ON s.{first} = p.{first} AND s.i = p.i + 1""",
        f"{name}_last": f"SELECT {first}, no, start, arg_max(cur, i) AS text "
                        f"FROM {name}_pack GROUP BY ALL",
        name: f"SELECT l.*, c.no AS paragraph_id, c.start, c.text FROM {name}_last c "
              f"JOIN (SELECT {keys} FROM {name}_list) l USING ({first})",
    }


ARTICLES = {"articles": "SELECT doc_id AS article_id, lang AS title, text FROM documents"}

PASSAGES = {
    **ARTICLES,
    "cleaned": f"SELECT article_id, title, {clean('text')} AS text FROM articles",
    "kept_articles": "SELECT min(article_id) AS article_id, title, text FROM cleaned "
                     "GROUP BY title, text",
    **chunks("chunked", "kept_articles", "article_id, title"),
    "passages": "SELECT article_id, paragraph_id, title, start, text, "
                "article_id * 16777216 + paragraph_id AS passage_id FROM chunked "
                "QUALIFY row_number() OVER (PARTITION BY title, text "
                "ORDER BY article_id, paragraph_id) = 1",
}

QA = {
    **ARTICLES,
    "qa_parts": rf"SELECT article_id, title, text, string_split(regexp_replace(text, '{GAP}', "
                rf"'\1' || chr(30), 'g'), chr(30)) AS p FROM articles",
    "qa": "SELECT article_id AS qa_id, article_id, title, text AS context, p[1] AS question, "
          "p[len(p) // 2 + 1] AS answer, CASE WHEN p[len(p) // 2 + 1] <> '' THEN "
          "instr(text, p[len(p) // 2 + 1]) - 1 END AS answer_start FROM qa_parts",
}

DIALOGUES = {
    "dialogues": "SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer, "
                 "u.conv_id * 1000000 + u.turn AS dialog_id FROM conversations u "
                 "JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 "
                 "WHERE u.role = 'user' AND a.role = 'assistant'",
}

VALIDATION = {
    **DIALOGUES,
    "validation": f"SELECT DISTINCT question FROM dialogues WHERE {in_test(0.1, 1, 'conv_id')}",
}

PREDICTIONS = {
    **DIALOGUES,
    "predictions": f"SELECT dialog_id, question, answer AS gold, CASE WHEN "
                   f"{hash_number(3, 'dialog_id')} % 2 = 0 THEN 'The ' || answer || ' !' "
                   f"ELSE question END AS prediction FROM dialogues",
}

BENCHMARK = {"questions": "SELECT item_id AS question_id, text FROM benchmark"}


def hashed(name: str, source: str, id_col: str, text: str) -> dict[str, str]:
    """Long form of the hashed bag-of-words vectors: (id, slot, x)."""
    return {
        f"{name}_slots": f"SELECT {id_col}, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 256 "
                         f"AS slot, count(*) AS n FROM (SELECT {id_col}, unnest({words(text)}) "
                         f"AS w FROM {source}) GROUP BY ALL",
        name: f"SELECT {id_col}, slot, CAST(CAST(n / sqrt(sum(n * n) OVER "
              f"(PARTITION BY {id_col})) AS FLOAT) AS DOUBLE) AS x FROM {name}_slots",
    }


DENSE = {
    **PASSAGES, **BENCHMARK,
    **hashed("qvec", "questions", "question_id", "text"),
    **hashed("pvec", "passages", "passage_id", "'제목: ' || title || ' 글: ' || text"),
    "dense_all": "SELECT question_id, passage_id, round(coalesce(s.dot, 0.0), 9) AS score "
                 "FROM questions CROSS JOIN (SELECT passage_id FROM passages) LEFT JOIN "
                 "(SELECT question_id, passage_id, sum(q.x * p.x) AS dot FROM qvec q "
                 "JOIN pvec p USING (slot) GROUP BY ALL) s USING (question_id, passage_id)",
    "dense_ranked": "SELECT question_id, passage_id, score, row_number() OVER (PARTITION BY "
                    "question_id ORDER BY score DESC, passage_id) AS rank FROM dense_all",
}

RETRIEVED = {
    **DENSE,
    "retrieved": "SELECT question_id, rank, passage_id, title, p.text, score FROM dense_ranked "
                 "JOIN passages p USING (passage_id) WHERE rank <= 5",
}

SPARSE = {
    **PASSAGES, **BENCHMARK,
    "qterms": f"SELECT question_id, term, count(*) AS qtf FROM (SELECT question_id, "
              f"unnest({words('text')}) AS term FROM questions) GROUP BY ALL",
    "pwords": f"SELECT passage_id, {words('text')} AS w FROM passages",
    "pstats": "SELECT count(*) AS n, avg(len(w)) AS mean FROM pwords",
    "pterms": "SELECT passage_id, term, len, count(*) AS tf FROM (SELECT passage_id, len(w) AS len, "
              "unnest(w) AS term FROM pwords) GROUP BY ALL",
    "pdf": "SELECT term, count(*) AS df FROM pterms GROUP BY term",
    "sparse_all": "SELECT question_id, passage_id, round(sum(qtf * ln(1 + (n - df + 0.5) / "
                  "(df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 9) AS score "
                  "FROM qterms JOIN pdf USING (term) JOIN pterms USING (term), pstats GROUP BY ALL",
    "sparse_ranked": "SELECT question_id, passage_id, score, row_number() OVER (PARTITION BY "
                     "question_id ORDER BY score DESC, passage_id) AS rank FROM sparse_all",
}

VECTORS = {
    "vec": "SELECT vec_id AS passage_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings",
    "vlong": "SELECT passage_id, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM vec",
    "qlong": "SELECT (passage_id - o + n) % n AS question_id, pos, sum(x) AS x FROM vlong, "
             "(SELECT count(*) AS n FROM vec), range(7) r(o) GROUP BY ALL",
    "qv": "SELECT question_id, list(x ORDER BY pos) AS v FROM qlong GROUP BY question_id",
    "scored": "SELECT question_id, passage_id, round(list_dot_product(qv.v, vec.v), 9) AS score "
              "FROM qv CROSS JOIN vec",
    "gold": "SELECT question_id, score AS gold_score FROM scored WHERE question_id = passage_id",
    "ranks": "SELECT question_id, gold_score, count(*) FILTER (score > gold_score OR "
             "(score = gold_score AND passage_id < question_id)) + 1 AS gold_rank "
             "FROM scored JOIN gold USING (question_id) GROUP BY ALL",
}

NEIGHBOURS = {
    **VECTORS,
    "near": "SELECT a.passage_id AS row_id, a.label AS target, b.passage_id, b.label AS class, "
            "round(list_dot_product(a.v, b.v), 9) AS score, row_number() OVER (PARTITION BY "
            "a.passage_id ORDER BY round(list_dot_product(a.v, b.v), 9) DESC, b.passage_id) AS rank "
            "FROM vec a JOIN vec b ON a.passage_id <> b.passage_id QUALIFY rank <= 20",
}

HISTORY = {
    "history": "SELECT 'main' AS run, event_type AS name, date_diff('day', DATE '2024-01-01', "
               "CAST(ts AS DATE)) AS epoch, round(avg(value), 9) AS value FROM events GROUP BY ALL",
}

TOKEN = (r"제목:|글:|질문:|</s>|[\p{L}\p{N}]+"
         r"|[^\p{L}\p{N}\x09-\x0D\x1C-\x20\x{85}\p{Z}]")


def tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{TOKEN}')"


def vocabulary(source: str, text: str) -> dict[str, str]:
    return {
        "learned": f"SELECT token, count(*) AS n FROM (SELECT unnest({tokens(text)}) AS token "
                   f"FROM {source}) WHERE token NOT IN ('제목:', '글:', '질문:', '</s>') "
                   f"GROUP BY token",
        "vocab": "SELECT token, 7 + row_number() OVER (ORDER BY n DESC, token) AS token_id "
                 "FROM learned UNION ALL VALUES ('제목:', 4), ('글:', 5), ('질문:', 6), "
                 "('</s>', 7)",
    }


def encoded(name: str, source: str, id_col: str, text: str, limit: int) -> dict[str, str]:
    """(id, ids): the first ``limit`` tokens as vocabulary ids, in order."""
    return {
        f"{name}_t": f"SELECT {id_col}, {tokens(text)}[1:{limit}] AS t FROM {source}",
        f"{name}_l": f"SELECT {id_col}, unnest(t) AS token, generate_subscripts(t, 1) AS pos "
                     f"FROM {name}_t",
        f"{name}_e": f"SELECT {id_col}, list(coalesce(token_id, 1) ORDER BY pos) AS ids "
                     f"FROM {name}_l LEFT JOIN vocab USING (token) GROUP BY {id_col}",
        name: f"SELECT {id_col}, coalesce(ids, []) AS ids FROM {name}_t "
              f"LEFT JOIN {name}_e USING ({id_col})",
    }


def batches(name: str, source: str, ids: list[str], size: int) -> dict[str, str]:
    """Seeded shuffle order cut into full batches."""
    text = " || '-' || ".join(f"{i}" for i in ids)
    return {
        f"{name}_n": f"SELECT *, row_number() OVER (ORDER BY md5('0-' || {text}), "
                     f"{', '.join(ids)}) - 1 AS position, count(*) OVER () AS total FROM {source}",
        name: f"SELECT *, position // {size} AS batch_id, CAST(position % {size} AS INT) AS slot "
              f"FROM {name}_n WHERE position // {size} < total // {size}",
    }


def with_(parts: dict[str, str], select: str) -> str:
    body = ",\n".join(f"{name} AS ({text})" for name, text in parts.items())
    return f"WITH RECURSIVE {body}\n{select}"
