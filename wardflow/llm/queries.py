"""The operators applied to their whole tables, and SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardflow.llm.exact_dedup import exact_dedup
from wardflow.llm.html_extract import extract
from wardflow.llm.language_id import identify_documents
from wardflow.llm.license_scan import _NO_HOLDER, NOTICES, SPELLINGS, scan_licenses
from wardflow.llm.license_texts import TEXTS
from wardflow.llm.merkle_manifest import prove
from wardflow.llm.mixing import MARGINS, ROUNDS, TEMPER, mix
from wardflow.llm.near_dedup import near_dedup
from wardflow.llm.packing import pack
from wardflow.llm.quality_cascade import judge_quality
from wardflow.llm.ranked_search import RESULTS, search
from wardflow.llm.secret_scan import scan_secrets
from wardflow.llm.token_counts import document_tokens
from wardflow.llm.url_filter import (
    BAD_SHARE,
    DEVIATIONS,
    LEAST_WEIGHT,
    LOWER,
    MOST_WEIGHT,
    RULES,
    SHARED_SUFFIXES,
    UPPER,
    judge_urls,
)


def _documents(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _pages(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": _pages(extract),
    "op2_license_scan": _documents(scan_licenses),
    "op3_secret_scan": _documents(scan_secrets),
    "op4_quality_cascade": _documents(judge_quality),
    "op5_mix_sources": _documents(mix),
    "op6_minhash_near_dedup": _documents(near_dedup),
    "op7_exact_dedup": _documents(exact_dedup),
    "op8_language_id": _documents(identify_documents),
    "op9_token_counts": _documents(document_tokens),
    "op10_best_fit_packing": _documents(pack),
    "op11_ranked_search": lambda spark, sf_dir: search(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    ),
    "op12_merkle_manifest": _documents(prove),
    "op13_url_filter": lambda spark, sf_dir: judge_urls(
        spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    ),
}



def _raking_sql() -> str:
    """The mixing operator in SQL: one pair of steps per round and margin."""
    steps, last = [], "c"
    for margin in MARGINS:
        steps.append(
            f"t_{margin} AS (SELECT {margin}, pow(sum(tokens), {TEMPER}) / sum(pow(sum(tokens), {TEMPER})) OVER () AS target"
            f" FROM c GROUP BY {margin})"
        )
    for turn in range(ROUNDS):
        for margin in MARGINS:
            here = f"r{turn}_{margin}"
            steps.append(
                f"{here} AS MATERIALIZED (SELECT source, language, topic, tokens, weight * target / has AS weight FROM {last}"
                f" JOIN t_{margin} USING ({margin}) JOIN (SELECT {margin}, sum(weight) AS has FROM {last} GROUP BY {margin})"
                f" USING ({margin}))"
            )
            last = here
    return rf"""
        WITH d AS MATERIALIZED (
            SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS language, CASE
                WHEN regexp_matches(x, '(?i)\b(licen[sc]ed? under|all rights reserved|released under)') THEN 'legal'
                WHEN (length(x) - length(translate(x, '#*$%&|<>{{}}=;', ''))) * 20 > length(x) THEN 'symbols'
                WHEN length(x) < 1000 THEN 'brief' WHEN length(x) < 10000 THEN 'article' ELSE 'long' END AS topic,
                greatest(len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')), 1)::BIGINT AS tokens
            FROM (SELECT *, coalesce(text, '') AS x FROM documents)
        ),
        c AS MATERIALIZED (
            SELECT source, language, topic, sum(tokens)::BIGINT AS tokens, sum(tokens)::DOUBLE AS weight FROM d GROUP BY ALL
        ),
        {", ".join(steps)},
        p AS (SELECT source, language, topic, weight / tokens / max(weight / tokens) OVER () AS p FROM {last})
        SELECT doc_id, source, language, topic, d.tokens, round(p, 9) AS p,
            ('0x' || md5('mix:' || doc_id)[1:13])::BIGINT::DOUBLE / 4503599627370496.0 < p AS drawn
        FROM d JOIN p USING (source, language, topic)
    """.replace("\\\\", "\\")


def _canonical_sql(text: str) -> str:
    # RE2 has no lookahead: mark what is no copyright line, drop the others, take the mark away.
    out = f"regexp_replace(lower({text}), '\\bcopyright ({_NO_HOLDER})\\b', 'copyright' || chr(1) || '\\1', 'g')"
    out = rf"regexp_replace({out}, '(?m)^[ \t]*(?:\(c\)|©|copyright(?:[^\pL\pN_\x01\n][^\n]*)?$)[^\n]*', ' ', 'g')"
    out = f"replace({out}, chr(1), ' ')"
    out = rf"regexp_replace({out}, '[\t-\r ]+', ' ', 'g')"
    for spelling, same in SPELLINGS:
        out = f"regexp_replace({out}, '{spelling}', '{same.replace('$', chr(92))}', 'g')"
    return rf"trim(regexp_replace({out}, '[^\pL\pN]+', ' ', 'g'))"


def _license_sql() -> str:
    known = [*NOTICES, *((name, text) for name, _, text in TEXTS)]
    known += [(name, f"{title}\n\n{text}") for name, titles, text in TEXTS for title in titles]
    values = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in known)
    forms = rf"""
        SELECT *, array_to_string(forms, ' ') AS form FROM (
            SELECT * EXCLUDE (text), list_filter(list_transform(regexp_split_to_array(text, '\n[\t-\r ]*\n'), lambda p: {_canonical_sql("p")}), lambda p: p != '') AS forms
            FROM ({{}})
        )"""
    return f"""
        WITH k AS (SELECT DISTINCT * FROM ({forms.format(f"SELECT * FROM (VALUES {values}) AS v(license, text)")}) WHERE len(forms) > 0),
        d AS MATERIALIZED ({forms.format("SELECT doc_id, text FROM documents WHERE text <> ''")}),
        n AS (SELECT DISTINCT len(forms) AS n FROM k),
        u AS (
            SELECT doc_id, form, NULL AS run, 'whole' AS kind FROM d
            UNION ALL
            SELECT doc_id, {_canonical_sql("line")}, NULL, 'line' FROM (
                SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text <> ''
            )
            UNION ALL
            SELECT doc_id, NULL, forms[i : i + n - 1], 'run' FROM (
                SELECT doc_id, forms, n, unnest(range(1, len(forms) - n + 2)) AS i FROM d JOIN n ON len(forms) > n
            )
        )
        SELECT doc_id, license, bool_or(kind = 'whole') AS whole, count(*) FILTER (WHERE kind = 'line') AS n_lines,
            count(*) FILTER (WHERE kind = 'run') AS n_runs
        FROM (
            SELECT doc_id, license, kind FROM u JOIN (SELECT DISTINCT license, form FROM k) USING (form)
            UNION ALL
            SELECT doc_id, license, kind FROM u JOIN (SELECT DISTINCT license, forms FROM k) AS r ON u.run = r.forms
        ) GROUP BY doc_id, license
    """


def _search_sql() -> str:
    terms = (
        f"unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),"
        r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"
    )
    return f"""
        WITH word AS (SELECT row, doc_id, {terms} FROM (SELECT row_number() OVER () AS row, * FROM documents)),
        tf AS (SELECT row, doc_id, term, count(*) AS tf FROM word GROUP BY ALL),
        doc AS (SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row),
        total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM doc),
        m AS (SELECT row, 100 - 90 + ((90 * n * docs) // terms) AS m FROM doc, total),
        w AS (
            SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, docs
        ),
        item AS (
            SELECT DISTINCT item, item_id, term
            FROM (SELECT item, item_id, {terms} FROM (SELECT row_number() OVER () AS item, * FROM benchmark))
        ),
        hit AS (
            SELECT item, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
            FROM item JOIN w USING (term) JOIN tf USING (term) JOIN m USING (row) GROUP BY ALL
        )
        SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
        FROM hit WHERE score > 0 QUALIFY rank <= {RESULTS}
    """


def _merkle_sql() -> str:
    """Trees level by level: a node is (tree, level, i), and ``grp`` is the language or, above them, null."""

    def row(n_chars: str) -> str:
        columns = ("doc_id", "source", "lang", n_chars, "text")
        return "sha256(" + " || ".join(
            f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')" for c in columns
        ) + ")"

    def tree(name: str, base: str) -> str:
        return f"""
            {name} AS (
                SELECT grp, 0 AS level, i, h, count(*) OVER (PARTITION BY grp) AS n FROM {base}
                UNION ALL
                SELECT grp, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2
                FROM {name} WHERE n > 1 GROUP BY grp, level, i // 2, n
            )"""

    def climb(name: str, nodes: str, base: str) -> str:
        # The proof is gathered in text; a node without a sibling is hashed alone.
        return f"""
            {name} AS (
                SELECT row, doc_id, leaf, grp, 0 AS level, i, h, proof FROM {base}
                UNION ALL
                SELECT c.row, c.doc_id, c.leaf, c.grp, c.level + 1, c.i // 2,
                    sha256(CASE WHEN c.i % 2 = 1 THEN s.h || c.h ELSE c.h || coalesce(s.h, '') END), c.proof || coalesce(s.h, '')
                FROM {name} c
                JOIN (SELECT DISTINCT grp, level, n FROM {nodes}) l
                    ON l.grp IS NOT DISTINCT FROM c.grp AND l.level = c.level AND l.n > 1
                LEFT JOIN {nodes} s ON s.grp IS NOT DISTINCT FROM c.grp AND s.level = c.level AND s.i = xor(c.i, 1)
            )"""

    # CRC-32 bit by bit over the characters of the id.
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),"
        " lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),"
        " lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
    )
    return f"""
        WITH RECURSIVE base AS MATERIALIZED (
            SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
            FROM (
                SELECT row_number() OVER () AS row, doc_id, lang AS grp, {row("n_chars")} AS leaf,
                    CASE WHEN {crc} % 7 = 0 THEN {row("(n_chars + 1)")} ELSE {row("n_chars")} END AS changed
                FROM documents
            )
        ),
        {tree("low", "(SELECT grp, i, leaf AS h FROM base)")},
        subroot AS MATERIALIZED (
            SELECT grp AS lang, h, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS i FROM low WHERE n = 1
        ),
        {tree("high", "(SELECT 'all' AS grp, i, h FROM subroot)")},
        {climb("c", "low", "(SELECT row, doc_id, leaf, grp, i, changed AS h, '' AS proof FROM base)")},
        top AS MATERIALIZED (SELECT * FROM c QUALIFY level = max(level) OVER (PARTITION BY row)),
        {climb("d", "high", "(SELECT row, doc_id, leaf, 'all' AS grp, s.i, top.h, proof FROM top JOIN subroot s ON s.lang IS NOT DISTINCT FROM top.grp)")}
        SELECT d.doc_id, d.leaf, s.h AS subroot, r.h AS root, sha256(d.proof) AS proof_sha256, d.h AS folded_root, d.h = r.h AS verified
        FROM (SELECT * FROM d QUALIFY level = max(level) OVER (PARTITION BY row)) d
        JOIN (SELECT h FROM high WHERE n = 1) r ON true
        JOIN base b USING (row)
        JOIN subroot s ON s.lang IS NOT DISTINCT FROM b.grp
    """


def _url_sql() -> str:
    shared = "|".join(SHARED_SUFFIXES)
    last = rf"(?:(?:(?:{shared})\.[a-z][a-z])|[^.]*)"
    rules = " UNION ALL ".join(f"SELECT '{r.verdict}' AS verdict, '{r.host}' AS rhost, '{r.path}' AS rpath" for r in RULES)

    def weight(name: str, groups: str, parent: str) -> str:
        return f"""
            {name} AS (
                SELECT CASE WHEN rho > 0 THEN least(greatest(1 / rho - 1, {LEAST_WEIGHT}), {MOST_WEIGHT}) ELSE {MOST_WEIGHT} END AS w
                FROM (
                    SELECT CASE WHEN N > 0 AND k > parents AND N > k AND b + ((N - sizes) / (k - parents) - 1) * v > 0
                        THEN (b - v) / (b + ((N - sizes) / (k - parents) - 1) * v) END AS rho
                    FROM (
                        SELECT sum(k) AS k, count(*) AS parents, sum(N) AS N, sum(sizes / N) AS sizes,
                            sum(squares - N * mean * mean) / nullif(sum(k) - count(*), 0) AS b,
                            sum(within) / nullif(sum(N) - sum(k), 0) AS v
                        FROM (
                            SELECT count(*) AS k, sum(labelled)::DOUBLE AS N, sum(bad) / sum(labelled) AS mean,
                                sum(labelled * (bad / labelled) * (bad / labelled)) AS squares,
                                sum(labelled * (bad / labelled) * (1 - bad / labelled)) AS within,
                                sum(labelled::DOUBLE * labelled) AS sizes
                            FROM {groups} WHERE labelled > 0 GROUP BY {parent}
                        )
                    )
                )
            )"""

    return rf"""
        WITH p AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM (
                SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
            )
        ),
        known AS (
            SELECT doc_id, max((coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0)::INT) AS bad
            FROM labels WHERE toxic IS NOT NULL OR quality IS NOT NULL GROUP BY doc_id
        ),
        hosts AS MATERIALIZED (
            SELECT *, CASE WHEN is_number OR d = '' THEN name ELSE d END AS domain, CASE WHEN is_number THEN '' ELSE s END AS suffix
            FROM (
                SELECT *, regexp_extract(name, '(?:^|\.)({last})\z', 1) AS s, regexp_extract(name, '([^.]*\.{last})\z', 1) AS d,
                    regexp_matches(name, '^[0-9]+(\.[0-9]+){{3}}\z') AS is_number
                FROM (
                    SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*\z', '') AS name,
                        count(bad) AS labelled, coalesce(sum(bad), 0) AS bad
                    FROM p LEFT JOIN known
                        ON doc_id = try_cast(regexp_extract(path, '/([0-9]{{1,18}})(?:\.[A-Za-z]+)?/?\z', 1) AS BIGINT)
                    GROUP BY host
                )
            )
        ),
        domains AS MATERIALIZED (SELECT domain, suffix, sum(labelled) AS labelled, sum(bad) AS bad FROM hosts GROUP BY ALL),
        suffixes AS MATERIALIZED (SELECT suffix, sum(labelled) AS labelled, sum(bad) AS bad FROM domains GROUP BY ALL),
        {weight("w3", "suffixes", "()")},
        {weight("w2", "domains", "suffix")},
        {weight("w1", "hosts", "domain")},
        a AS (SELECT (sum(bad) + 0.5) / (sum(labelled) + 1.0) AS mean FROM suffixes),
        top AS (SELECT suffix, (bad + w * mean) / (labelled + w) AS prior FROM suffixes, w3, a),
        middle AS (SELECT domain, (bad + w * prior) / (labelled + w) AS prior FROM domains JOIN top USING (suffix), w2),
        fame AS (
            SELECT host, share - {DEVIATIONS} * sqrt(share * (1 - share) / (labelled + w + 1)) AS bound
            FROM (SELECT host, labelled, w, (bad + w * prior) / (labelled + w) AS share FROM hosts JOIN middle USING (domain), w1)
        ),
        hit AS (
            SELECT host, path, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(verdict, length(rhost || rpath)) AS verdict
            FROM (SELECT DISTINCT host, path FROM p) JOIN ({rules}) r
                ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
            GROUP BY host, path
        )
        SELECT page_id, p.host, p.path, rule, coalesce(verdict, CASE WHEN bound > {BAD_SHARE} THEN 'block' ELSE 'allow' END) AS verdict
        FROM p JOIN fame USING (host) LEFT JOIN hit ON hit.host = p.host AND hit.path = p.path
    """


ORACLE: dict[str, str] = {
    "op11_ranked_search": _search_sql(),
    "op12_merkle_manifest": _merkle_sql(),
    "op13_url_filter": _url_sql(),
    "op2_license_scan": _license_sql(),
    "op4_quality_cascade": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
        w AS (SELECT doc_id, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS words FROM t),
        p AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM w),
        q AS (
            SELECT doc_id, i, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c, lead(word, 3) OVER o AS d,
                lead(word, 4) OVER o AS e
            FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)
        ),
        r AS (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c, d, e) > 1 AS again FROM q WHERE e IS NOT NULL
        ),
        u AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, unnest([0, 1, 2, 3, 4]) AS s(k) WHERE again GROUP BY doc_id),
        l AS (SELECT doc_id, unnest(string_split(x, chr(10))) AS line FROM t),
        d AS (
            SELECT doc_id, count(*) FILTER (WHERE regexp_matches(line, '[^\x20\x09-\x0D]')) AS n,
                count(DISTINCT line) FILTER (WHERE regexp_matches(line, '[^\x20\x09-\x0D]')) AS m, count(*) AS lines
            FROM l GROUP BY doc_id
        ),
        f AS (
            SELECT w.doc_id, x, len(words)::BIGINT AS n_words, length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                length(x) - length(translate(x, '#*$%&|<>', '')) AS n_symbols, (d.n - d.m) AS n_dup_lines,
                coalesce(u.n, 0) AS n_repeat_words, d.lines,
                length(x) - length(regexp_replace(x, '\pL', '', 'g')) AS letters,
                length(x) - length(regexp_replace(x, '\p{Lu}', '', 'g')) AS capitals,
                length(x) - length(translate(x, '!?', '')) AS marks
            FROM w JOIN d USING (doc_id) LEFT JOIN u USING (doc_id)
        ),
        g AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed AND 10 * n_symbols <= word_chars AND 2 * n_dup_lines <= lines
            AND 2 * n_words <= word_chars AND word_chars <= 20 * n_words AND 2 * capitals <= word_chars
            AND 2 * letters >= word_chars AND 4 * marks <= n_words AS kept
        FROM g
    """,
    "op5_mix_sources": _raking_sql(),
    "op6_minhash_near_dedup": r"""
        WITH RECURSIVE t AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
        ),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(words[i + 1 : i + 3], ' ') AS shingle
            FROM (SELECT doc_id, words, unnest(range(greatest(len(words) - 2, 1))) AS i FROM t WHERE len(words) > 0)
        ),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (shingle) GROUP BY ALL),
        link AS (
            SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
        ),
        reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
        low AS (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a)
        SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low.c, t.doc_id) AS component_id,
            coalesce(low.c, t.doc_id) = t.doc_id AS kept
        FROM t LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
    """,
    "op7_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS n, sha256(translate(coalesce(text, ''), E' \t\n\x0b\f\r', '')) AS h
            FROM documents
        ), g AS (
            SELECT h, count(*) AS c, min(doc_id) FILTER (WHERE n = m) AS k
            FROM (SELECT *, max(n) OVER (PARTITION BY h) AS m FROM t) GROUP BY h
        )
        SELECT doc_id, k AS keep_id, c AS group_size, doc_id = k AS kept, t.h AS text_sha256 FROM t JOIN g ON t.h = g.h
    """,
}
