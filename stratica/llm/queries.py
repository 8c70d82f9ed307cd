"""One registered query per operator, over its whole table, and the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratica.llm import (
    chat,
    decontaminate,
    extract,
    host_rules,
    merkle,
    mixing,
    occurrence_join,
    quality_fm,
    repair,
    secret_scan,
    simhash,
    token_prefixes,
    toxicity,
)
from stratica.llm.common import remainder
from stratica.proofs.registry import table
from stratica.session import prepare

QUALITY_CUT = 0.3
TOXIC_CUT = 0.7


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(prepare(spark), folder, "documents")


def op1_quality_fm(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder).select("doc_id", "text")
    out = quality_fm.quality(docs, table(spark, folder, "labels"))
    return out.select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"),
    )


def op2_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    return host_rules.verdicts(_documents(spark, folder)).select("doc_id", *host_rules.FIGURES, "base_failed", "kept")


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, folder))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(_documents(spark, folder), table(spark, folder, "benchmark"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder).select("doc_id", "text", "source")
    return mixing.mixed(docs, mixing.plan(docs)).select("doc_id", "mix.*")


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.rendered(table(prepare(spark), folder, "conversations"))


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(_documents(spark, folder)).drop("secrets")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder).select("doc_id", "text")
    out = toxicity.toxicity(docs, table(spark, folder, "labels"))
    return out.select(
        "doc_id",
        (remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_CUT).cast("int").alias("predicted"),
    )


def op9_token_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_prefixes.counted(_documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(prepare(spark), folder, "pages")
    return extract.extracted(pages, extract.learned(pages))


def op11_occurrence_join(spark: SparkSession, folder: str) -> DataFrame:
    return occurrence_join.joined(_documents(spark, folder))


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.proofs(_documents(spark, folder))


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repaired(table(prepare(spark), folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_fm, op2_host_rules, op3_simhash, op4_decontamination, op5_mixing, op6_chat, op7_secrets, op8_toxicity,
        op9_token_prefixes, op10_main_text, op11_occurrence_join, op12_merkle, op13_repair,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: CRC-32 of ids as text, bit by bit; ``hit`` has those that 7 divides.
_CRC = """c AS (SELECT doc_id, 0 AS i, 4294967295 AS crc, CAST(doc_id AS VARCHAR) AS name FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
            UNION ALL
            SELECT doc_id, i + 1, list_reduce([xor(crc, ord(name[i + 1]))] || range(8), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END),
                   name FROM c WHERE i < strlen(name)),
      hit AS (SELECT doc_id FROM c WHERE i = strlen(name) AND xor(crc, 4294967295) % 7 = 0)"""

_UNSPACED = "".join(rf"\p{{{script}}}" for script in decontaminate.UNSPACED)

ORACLES: dict[str, str] = {
    "op2_host_rules": rf"""
      WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
      w AS (SELECT *, {_WORDS} AS words FROM d),
      windows AS (SELECT r, i, words[i:i + 7] AS win FROM w, unnest(range(1, len(words) - 6)) AS t(i)),
      twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
      again AS (SELECT r, count(DISTINCT i + j) AS n FROM twice, range(8) AS u(j) GROUP BY r),
      lines AS (SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
                WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
      dup AS (SELECT r, sum(n - 1) AS dups, sum(n) AS n_lines FROM lines GROUP BY r),
      f AS (SELECT r, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
                   CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                   CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                   CAST(coalesce(dups, 0) AS BIGINT) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
                   CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words
            FROM w LEFT JOIN dup USING (r) LEFT JOIN again USING (r)),
      j AS (SELECT *, n_words < {host_rules.LEAST_WORDS}
                      OR 100 * n_repeat_words > {host_rules.MOST_REPEATED_PERCENT} * n_words AS base_failed,
                   100 * n_symbols > {host_rules.MOST_SYMBOLS_PERCENT} * n_words
                      OR 100 * n_dup_lines > {host_rules.MOST_DUP_LINES_PERCENT} * n_lines AS minor_failed FROM f),
      h AS (SELECT source, count(*) AS docs, count(*) FILTER (base_failed OR minor_failed) AS failures FROM j GROUP BY source),
      m AS (SELECT sum(docs) AS n, sum(failures) / sum(docs) AS mean, sum(docs * docs) AS squares, count(*) AS hosts FROM h),
      v AS (SELECT any_value(n) AS n, any_value(mean) AS mean, any_value(mean * (1 - mean)) AS chance,
                   (sum(docs * (failures / docs - mean) ** 2) - any_value((hosts - 1) * mean * (1 - mean)))
                     / any_value(n - squares / n) AS between_hosts FROM h, m),
      s AS (SELECT n, mean, least(greatest(CASE WHEN between_hosts > 0 THEN chance / between_hosts - 1 ELSE n END, 1), n) AS strength
            FROM v)
      SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
             NOT base_failed AND (failures + mean * strength) / (docs + strength) <= {host_rules.FAILED}
               AND NOT (minor_failed AND (failures + mean * strength) / (docs + strength) > {host_rules.SUSPECT}) AS kept
      FROM j JOIN h ON j.source IS NOT DISTINCT FROM h.source, s""",
    "op4_decontamination": rf"""
      WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(regexp_replace(lower(coalesce(text, '')), '([{_UNSPACED}])', ' \1 ', 'g'), '[\pL\pN]+') AS w FROM documents),
      b AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(regexp_replace(lower(coalesce(text, '')), '([{_UNSPACED}])', ' \1 ', 'g'), '[\pL\pN]+') AS w FROM benchmark),
      dw AS (SELECT r, i - 1 AS pos, w[i] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(i)),
      bw AS (SELECT q, i - 1 AS pos, w[i] AS word, len(w) AS n FROM b, unnest(range(1, len(w) + 1)) AS t(i)
             WHERE len(w) >= {decontaminate.SHORTEST}),
      same AS (SELECT r, q, dw.pos - bw.pos AS diagonal, bw.pos AS pos, n FROM dw JOIN bw USING (word)),
      windows AS (SELECT r, q, diagonal, pos, least(n, {decontaminate.WINDOW}) AS width, n,
                         count(*) OVER (PARTITION BY r, q, diagonal) AS agreeing
                  FROM same QUALIFY count(*) OVER (PARTITION BY r, q, diagonal) >= least(n, {decontaminate.AGREE})),
      spans AS (SELECT DISTINCT r, q, diagonal, width, agreeing, n, pos - k AS first FROM windows, range({decontaminate.WINDOW}) AS u(k)
                WHERE k < width AND pos - k >= 0),
      inside AS (SELECT s.*, d.doc_id, b.item_id, len(d.w) AS doc_n FROM spans s JOIN d USING (r) JOIN b USING (q)
                 WHERE first + width <= n AND first + diagonal >= 0 AND first + diagonal + width <= len(d.w)),
      counted AS (SELECT i.*, (SELECT count(*) FROM range(width) AS u(k)
                               WHERE (SELECT w FROM b WHERE b.q = i.q)[first + k + 1]
                                   = (SELECT w FROM d WHERE d.r = i.r)[first + diagonal + k + 1]) AS equal FROM inside i),
      best AS (SELECT * FROM counted WHERE equal >= CASE WHEN n < {decontaminate.WINDOW} THEN n ELSE {decontaminate.AGREE} END
               QUALIFY row_number() OVER (PARTITION BY r, q, diagonal ORDER BY first) = 1)
      SELECT doc_id, item_id, first + diagonal AS doc_at, first AS item_at, agreeing,
             least(n, doc_n - diagonal) - greatest(0, -diagonal) AS compared FROM best""",
    "op5_mixing": rf"""
      WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
                 FROM documents),
      s AS (SELECT source, sum(size) AS source_size,
                   [5, 2, 1][1 + (row_number() OVER (ORDER BY CAST(source AS BLOB) NULLS LAST) - 1) % 3] AS weight FROM d GROUP BY source),
      o AS (SELECT *, 3 * source_size AS cap,
                   sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
                   sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shares
            FROM s WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
      l AS (SELECT coalesce((SELECT CAST(rest AS DOUBLE) / shares FROM o WHERE cap > weight * (CAST(rest AS DOUBLE) / shares)
                             ORDER BY 3 * source_size / weight, source NULLS LAST LIMIT 1), 0) AS level),
      g AS (SELECT source, CAST(source_size AS BIGINT) AS source_size,
                   CASE WHEN 3 * source_size <= weight * level THEN CAST(3 * source_size AS DOUBLE) ELSE weight * level END AS target FROM s, l),
      e AS (SELECT source, key, doc_id, size, sum(size) AS words, count(*) AS n FROM d WHERE size > 0 GROUP BY ALL),
      p AS (SELECT e.*, source_size, target,
                   sum(words) OVER (PARTITION BY e.source ORDER BY key, doc_id NULLS FIRST, size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - words AS start
            FROM e JOIN g ON e.source IS NOT DISTINCT FROM g.source),
      q AS (SELECT source, least({mixing.PACKET}, words - c * {mixing.PACKET}) AS part,
                   CAST(r * source_size + start + c * {mixing.PACKET} + least({mixing.PACKET}, words - c * {mixing.PACKET}) AS DOUBLE)
                     / target AS finish
            FROM p, range({mixing.REPEATS}) AS t(r), unnest(range(CAST(ceil(words / {mixing.PACKET}) AS BIGINT))) AS u(c)),
      z AS (SELECT source, part, sum(part) OVER (ORDER BY finish, source NULLS LAST, part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                   - part AS ahead FROM q),
      v AS (SELECT source, sum(greatest(0, least(part, (SELECT sum(size) FROM d) - ahead))) AS served FROM z GROUP BY source),
      f AS (SELECT p.source, key, doc_id, size, n, start, words, served // source_size AS rounds, served % source_size AS rest
            FROM p JOIN v ON p.source IS NOT DISTINCT FROM v.source),
      k AS (SELECT source, key, doc_id, size,
                   rounds * size + CASE WHEN start + words <= rest THEN size WHEN start <= rest THEN (rest - start) // n ELSE 0 END AS taken
            FROM f)
      SELECT d.doc_id, d.size, g.source_size, g.target, CAST(coalesce(k.taken, 0) AS BIGINT) AS taken
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
      LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.key = k.key AND d.doc_id IS NOT DISTINCT FROM k.doc_id
        AND d.size = k.size""",
    "op6_chat": rf"""
      WITH t AS (SELECT DISTINCT conv_id, turn, lower(trim(role)) AS role, coalesce(text, '') AS text FROM conversations),
      n AS (SELECT conv_id, turn, text, CASE WHEN role IN ('gpt', 'bot', 'ai', 'model') THEN 'assistant' WHEN role = 'human' THEN 'user'
                   WHEN coalesce(role, '') = '' THEN 'unknown' ELSE role END AS role FROM t),
      p AS (SELECT conv_id, role, text, row_number() OVER o AS k, string_agg(role || chr(1) || text, chr(2)) OVER o AS said,
                   count(*) OVER (PARTITION BY conv_id) AS n FROM n WINDOW o AS (PARTITION BY conv_id ORDER BY turn)),
      whole AS (SELECT said, min(conv_id) AS conv_id, any_value(n) AS n_turns FROM p WHERE k = n GROUP BY said),
      kept AS (SELECT conv_id, n_turns FROM whole WHERE said NOT IN (SELECT said FROM p WHERE k < n))
      SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, CAST((k - 1) // {chat.PART} AS BIGINT) AS part,
             string_agg('{chat.OPEN}' || role || chr(10) || replace(text, '<|', '< |') || '{chat.CLOSE}', chr(10) ORDER BY k) AS text
      FROM p JOIN kept USING (conv_id) GROUP BY conv_id, n_turns, (k - 1) // {chat.PART}""",
    "op11_occurrence_join": r"""
      WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
      s AS (SELECT DISTINCT r, array_to_string(w[i:i + 2], ' ') AS shingle FROM d, unnest(range(1, greatest(len(w) - 1, 2))) AS t(i) WHERE len(w) > 0),
      n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
      links AS (SELECT x.r AS a, y.r AS b FROM s x JOIN s y USING (shingle) JOIN n u ON u.r = x.r JOIN n v ON v.r = y.r
                WHERE x.r <> y.r GROUP BY x.r, y.r, u.n, v.n HAVING 100 * count(*) >= 90 * (u.n + v.n - count(*))),
      reach AS (SELECT r, r AS o FROM d UNION SELECT reach.r, links.b FROM reach JOIN links ON reach.o = links.a)
      SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(e.doc_id) AS component_id
      FROM d LEFT JOIN n USING (r) JOIN reach USING (r) JOIN d e ON e.r = reach.o GROUP BY d.r, d.doc_id, n.n""",
    "op12_merkle": rf"""
      WITH RECURSIVE d AS (SELECT *, coalesce(CAST(strlen(CAST(doc_id AS VARCHAR)) AS VARCHAR) || ':' || doc_id, '-')
               || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
               coalesce(strlen(text) || ':' || text, '-') AS tail FROM documents),
      l AS (SELECT doc_id, coalesce('1' || lang, '0') AS tree, n_chars, head, tail,
                   sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf FROM d),
      o AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM l),
      t AS (SELECT tree, 0 AS level, rank, leaf AS digest FROM o
            UNION ALL
            SELECT tree, level + 1, rank // 2, sha256(string_agg(digest, '' ORDER BY rank))
            FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM t) WHERE n > 1 GROUP BY tree, level, rank // 2),
      top AS (SELECT tree, level AS height, digest AS subroot FROM t QUALIFY row_number() OVER (PARTITION BY tree ORDER BY level DESC) = 1),
      u AS (SELECT 0 AS level, row_number() OVER (ORDER BY CAST(tree AS BLOB)) - 1 AS rank, subroot AS digest FROM top
            UNION ALL
            SELECT level + 1, rank // 2, sha256(string_agg(digest, '' ORDER BY rank))
            FROM (SELECT *, count(*) OVER () AS n FROM u) WHERE n > 1 GROUP BY level, rank // 2),
      placed AS (SELECT *, row_number() OVER (ORDER BY CAST(tree AS BLOB)) - 1 AS place FROM top),
      apex AS (SELECT digest AS root, level AS height FROM u ORDER BY level DESC LIMIT 1),
      steps AS (SELECT o.tree, o.rank AS leaf_rank, t.level, t.digest FROM o JOIN t ON t.tree = o.tree
                  AND t.rank = xor(CAST(o.rank AS BIGINT) >> t.level, 1)
                UNION ALL
                SELECT o.tree, o.rank, p.height + u.level, u.digest FROM o JOIN placed p USING (tree) JOIN u
                  ON u.rank = xor(CAST(p.place AS BIGINT) >> u.level, 1)),
      proof AS (SELECT tree, leaf_rank AS rank, sha256(string_agg(digest, '' ORDER BY level)) AS proof_sha256 FROM steps GROUP BY ALL),
      {_CRC},
      f AS (SELECT o.tree, o.rank, o.doc_id, o.leaf, placed.subroot, coalesce(proof_sha256, sha256('')) AS proof_sha256, height, place,
                   n_chars IS NOT NULL AND doc_id IN (SELECT doc_id FROM hit) AS changed,
                   sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) AS other
            FROM o JOIN placed USING (tree) LEFT JOIN proof USING (tree, rank)),
      g AS (SELECT f.tree, f.rank, f.height, f.place, 0 AS level, CASE WHEN changed THEN other ELSE leaf END AS digest FROM f
            UNION ALL
            SELECT g.tree, g.rank, g.height, g.place, g.level + 1,
                   CASE WHEN n.digest IS NULL THEN sha256(g.digest)
                        WHEN (CASE WHEN g.level < g.height THEN g.rank >> g.level ELSE g.place >> (g.level - g.height) END) % 2 = 1
                        THEN sha256(n.digest || g.digest) ELSE sha256(g.digest || n.digest) END
            FROM g LEFT JOIN (SELECT tree, leaf_rank, level, digest FROM steps) n ON n.tree = g.tree AND n.leaf_rank = g.rank AND n.level = g.level
            WHERE g.level < g.height + (SELECT height FROM apex))
      SELECT f.doc_id, f.leaf, f.subroot, root, proof_sha256, g.digest AS folded_root, g.digest = root AS verified
      FROM f JOIN g ON f.tree = g.tree AND f.rank = g.rank AND g.level = f.height + (SELECT height FROM apex), apex""",
}
