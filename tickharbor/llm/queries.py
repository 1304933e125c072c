"""The operators as registered queries, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_digests
from .collocations import collocations
from .decontaminate import contamination
from .fill_middle import fill_in_middle
from .language import held_out_languages
from .line_dedup import MIN_CHARS, MIN_SITES, without_shared_lines
from .near_dedup import near_duplicates
from .pii import KINDS, protected_spans
from .quality import quality_report
from .substring_dedup import without_repeats
from .toxicity import held_out_scores
from .url_filters import PATTERN_RULES, SITE_RULES, judge_urls
from .warc import archive_and_index

VOCABULARY = "word_bpe_49k.json"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    digest, near = (F.sha2(F.array_join(name, ","), 256) for name in ("item_ids", "near_item_ids"))
    own = ["doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated"]
    return found.select(*own, "n_near_items", near.alias("near_items_sha256"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = archive_and_index(spark, read(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_languages(read(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_shared_lines(read(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    return out.select("doc_id", "n_lines", "n_removed", digest)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read(spark, sf_dir, "documents"), vocabulary_path())


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = protected_spans(read(spark, sf_dir, "documents"))
    counts = [f"n_{kind}" for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(read(spark, sf_dir, "documents"))
    digests = [F.sha2(name, 256).alias(f"{name}_sha256") for name in ("output", "restored")]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_near_dedup, op3_substring_dedup, op4_warc, op5_language, op6_line_dedup, op7_bpe,
        op8_pii, op9_quality, op10_toxicity, op11_collocations, op12_url_filters, op13_fill_middle,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SITES = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in SITE_RULES)
_WORDS = ", ".join(f"('{rule}')" for rule, _ in PATTERN_RULES)

ORACLES: dict[str, str] = {
    "op4_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
                   FROM pages),
        f AS (SELECT payload_digest, min(page_id) AS first_page FROM p WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id > first_page THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id > first_page THEN first_page END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)""",
    "op6_line_dedup": f"""
        WITH l AS (SELECT doc_id, coalesce(source, '') AS site, i, line, trim(line, ' ') AS t FROM (
                     SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                            generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
        s AS (SELECT t, min(doc_id) AS home FROM l WHERE length(t) >= {MIN_CHARS}
              GROUP BY t HAVING count(DISTINCT site) >= {MIN_SITES}),
        k AS (SELECT doc_id, i, line, coalesce(doc_id <> home, false) AS gone FROM l LEFT JOIN s USING (t))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS text_sha256
        FROM k GROUP BY doc_id""",
    "op11_collocations": rf"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                          unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                                    '[^.,;:!?\n\x0b\x0c\r]+')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM d),
        g AS (SELECT lang, m, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS phrase
              FROM w, (VALUES (1), (2), (3), (4)) AS lengths(m) WHERE len(w) >= m),
        f AS (SELECT lang, m, phrase, CAST(count(*) AS HUGEINT) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
        t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
        c AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f WHERE m > 1),
        s AS (SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, 2000000 * c.a // (l.a + r.a) AS score FROM c
              JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
              JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
        x AS (SELECT lang, phrase, max(a) AS longest FROM (
                SELECT lang, a, unnest([array_to_string(w[i:i + j - 1], ' ') FOR i IN range(1, m - j + 2)]) AS phrase
                FROM (SELECT DISTINCT lang, phrase, a, m, w, unnest(range(2, m)) AS j FROM c)) GROUP BY ALL),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        o AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
              FROM b LEFT JOIN x ON x.lang = b.lang AND x.phrase = b.phrase
              WHERE longest IS NULL OR 100 * longest < 80 * a)
        SELECT o.lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n,
               CAST(score AS BIGINT) AS score FROM o JOIN t ON t.lang = o.lang WHERE rank <= 2000""",
    "op12_url_filters": f"""
        WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
                   FROM pages),
        h AS (SELECT row_number() OVER () AS i, page_id,
                     translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
                     regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM u),
        rules AS (SELECT rule, verdict, string_split(rule, '/')[1] AS rule_host,
                         substr(rule, strpos(rule, '/')) AS rule_path FROM (VALUES {_SITES}) AS v(rule, verdict)),
        fits AS (SELECT i, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM h, rules
                 WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY i),
        words AS (SELECT i, arg_min(pattern, (-length(pattern), pattern)) AS pattern FROM h, (VALUES {_WORDS}) AS v(pattern)
                  WHERE regexp_matches(translate(host || path, '{_UPPER}', '{_LOWER}'),
                                       '(^|[^a-z0-9])' || trim(pattern, '^') || '([^a-z0-9]|$)') GROUP BY i)
        SELECT page_id, host, path, rule,
               coalesce(verdict, CASE WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
               CASE WHEN rule IS NULL THEN pattern END AS pattern
        FROM h LEFT JOIN fits USING (i) LEFT JOIN words USING (i)""",
    "op13_fill_middle": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        u AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units,
                     [CAST('0x' || substr(h, i, 8) AS UBIGINT) FOR i IN [1, 9, 17, 25]] AS hs FROM d),
        c AS (SELECT *, len(units) AS n, least(hs[1] % (len(units) + 1), hs[2] % (len(units) + 1)) AS low,
                     greatest(hs[1] % (len(units) + 1), hs[2] % (len(units) + 1)) AS high FROM u),
        f AS (SELECT doc_id, text, CAST(n AS BIGINT) AS n,
                     CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                               OR hs[3] % 100 >= 100 THEN 'plain'
                          WHEN hs[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
                     coalesce(array_to_string(units[1:CAST(low AS BIGINT)], ''), '') AS p,
                     coalesce(array_to_string(units[CAST(low AS BIGINT) + 1:CAST(high AS BIGINT)], ''), '') AS m,
                     coalesce(array_to_string(units[CAST(high AS BIGINT) + 1:], ''), '') AS s FROM c)
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                                ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM f""",
}
