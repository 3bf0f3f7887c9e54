"""Independent SQL for every oracle-checked catalogue query.

Written for DuckDB over the driver's pre-registered views.  Shared pieces
(file view, strip, tokenizers, stream) are composed from the same fixed
values as the Spark side, never from Spark code.
"""

from __future__ import annotations

from tokloom.config import (CODE_EXTENSIONS, CORE_SPECIALS, EOT_ID, EXCLUDE_PATTERNS, EXT_TO_TAG,
                            HASH_ID_BASE, HASH_ID_SPAN, LANG_TO_EXT, MAX_FILE_BYTES, PY_SPACE_CLASS,
                            SPECIALS, TRAIN_SHUFFLE_SEED, TREE_DIRS, VAL_RATIO, WHITE_SPACE)
from tokloom.functions.bytelevel import ALPHABET, byte_ids
from tokloom.functions.text import glob_to_regex
from tokloom.plans.token_queries import QUERY_MERGES


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + PY_SPACE_CLASS + '+|' + PY_SPACE_CLASS + '+\\z')}, '', 'g')"


def h32(*parts: str) -> str:
    """Portable hash: first 32 bits of md5 over '|'-joined parts."""
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT"


def uni(*parts: str) -> str:
    return f"({h32(*parts)} / 4294967296.0)"


_EXT_CASE = "CASE lang " + " ".join(
    f"WHEN {q(k)} THEN {q(v)}" for k, v in LANG_TO_EXT.items()) + " ELSE '.txt' END"

FILES = f"""files AS (
  SELECT doc_id, source || '/' || printf('%08d', doc_id) || ext AS path, ext, lang, source,
         strlen(text)::BIGINT AS n_bytes, text
  FROM (SELECT *, {_EXT_CASE} AS ext FROM documents) d0)"""

SUFFIX = "lower(regexp_extract(string_split(path, '/')[-1], '[^.].*?(\\.[^.]+)$', 1))"
_EXTS = ", ".join(q(e) for e in CODE_EXTENSIONS)
_SUBSTR = " OR ".join(f"contains(lower(path), {q(p.lower())})" for p in EXCLUDE_PATTERNS)
_GLOB = "|".join(glob_to_regex(p.lower()) for p in EXCLUDE_PATTERNS)


_DIRS = ", ".join(q(d) for d in TREE_DIRS)
TREE = f"""tree AS (SELECT list_extract([{_DIRS}], (doc_id % {len(TREE_DIRS)})::INT + 1) || '/'
    || source || '/' || printf('%08d', doc_id)
    || CASE WHEN doc_id % 11 = 0 THEN '.lock' WHEN ext = '.js' AND doc_id % 3 = 0 THEN '.min.js'
            WHEN doc_id % 13 = 0 THEN '.html' ELSE ext END AS path, n_bytes FROM files)"""


def discover_tree(mode: str) -> str:
    excl = _SUBSTR if mode == "substring" else (
        f"list_bool_or(list_transform(string_split(lower(path), '/'), lambda p: regexp_matches(p, {q(_GLOB)})))")
    return f"""WITH {FILES}, {TREE}
        SELECT path, {SUFFIX} AS ext, n_bytes FROM tree
        WHERE {SUFFIX} IN ({_EXTS}) AND NOT ({excl}) AND n_bytes BETWEEN 64 AND 1048576"""


def discovered(mode: str = "substring") -> str:
    if mode == "glob":
        excl = (f"list_bool_or(list_transform(string_split(lower(path), '/'), "
                f"lambda p: regexp_matches(p, {q(_GLOB)})))")
    else:
        excl = f"({_SUBSTR})"
    return f"""{FILES},
disc AS (SELECT * FROM files WHERE {SUFFIX} IN ({_EXTS}) AND NOT {excl}
         AND n_bytes BETWEEN 64 AND 1048576)"""


_TAG_CASE = "CASE ext " + " ".join(
    f"WHEN {q(e)} THEN {SPECIALS.index(t)}" for e, t in EXT_TO_TAG.items() if t) + " END"
_TAG_NAME = "CASE ext " + " ".join(
    f"WHEN {q(e)} THEN {q(t)}" for e, t in EXT_TO_TAG.items() if t) + " END"


def hash_ids(text: str) -> str:
    return (f"list_transform(regexp_extract_all({text}, '[^ \\t\\n\\r\\f]+'), "
            f"lambda w: ({HASH_ID_BASE} + (('0x' || substr(md5(w), 1, 8))::BIGINT % {HASH_ID_SPAN}))::INTEGER)")


STREAM = f"""{discovered()},
toks AS (SELECT doc_id, path, ext, {strip('text')} AS t FROM disc),
seq AS (SELECT doc_id, path,
          list_concat(CASE WHEN {_TAG_CASE} IS NULL THEN []::INTEGER[] ELSE [({_TAG_CASE})::INTEGER] END,
                      {hash_ids('t')}, [{EOT_ID}::INTEGER]) AS ids
        FROM toks WHERE length(t) > 0),
stream AS (SELECT doc_id, path, ids,
          coalesce(sum(len(ids)) OVER (ORDER BY string_split(path, '/')
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_off
        FROM seq),
tok AS (SELECT start_off + k AS pos, ids[k + 1] AS id
        FROM (SELECT start_off, ids, unnest(range(len(ids))) AS k FROM stream) u),
ntok AS (SELECT count(*)::BIGINT AS n FROM tok)"""

SPLIT = f"""{STREAM},
cutoff AS (SELECT n - greatest(1, floor(n * {VAL_RATIO})::BIGINT) AS n_train FROM ntok),
tok_train AS (SELECT pos, id FROM tok, cutoff WHERE pos < n_train),
tok_val AS (SELECT pos - n_train AS pos, id FROM tok, cutoff WHERE pos >= n_train)"""


#: Ids of the word-hash tokenizer take 15 bits of a packed context.
_ID_SPAN = 32768


def _ngrams(n: int) -> str:
    """(ctx, nxt, n) of order n over the training tokens."""
    ids = [f"lag(id, {k}) OVER (ORDER BY pos)" for k in range(n - 1, 0, -1)]
    ctx = " + ".join(f"c{i}::BIGINT * {_ID_SPAN ** (n - 2 - i)}" for i in range(n - 1))
    cols = ", ".join(f"{x} AS c{i}" for i, x in enumerate(ids))
    return f"""SELECT {ctx} AS ctx, id AS nxt, count(*)::BIGINT AS n FROM (SELECT id, {cols} FROM tok_train) w
        WHERE c0 IS NOT NULL GROUP BY 1, 2"""


def permuted(src: str, *key: str, rounds: int = 4, walks: int = 5) -> str:
    """Ends with r (win_id, nw, rk and the columns of key): the keyed
    permutation of 0 ... nw - 1 on a grid of a columns and b rows."""
    group = [k for k in key if not k.isdigit()]
    by = f"PARTITION BY {', '.join(group)}" if group else ""
    steps = [f"""g0 AS (SELECT *, (nw + a - 1) // a AS b, win_id AS spot FROM (
        SELECT *, floor(sqrt(greatest(nw - 1, 0)))::BIGINT + 1 AS a FROM (
          SELECT {', '.join(['win_id', *group])}, count(*) OVER ({by}) AS nw FROM {src}) z) y)"""]
    cols = ", ".join(["win_id", *group, "nw", "a", "b"])
    for w in range(walks):
        inner = f"SELECT {cols}, spot, spot // b AS c, spot % b AS d FROM g{w}"
        for i in range(rounds):
            move = (f"(c + {h32(*key, str(i), 'd')}) % a AS c, d" if i % 2 == 0
                    else f"c, (d + {h32(*key, str(i), 'c')}) % b AS d")
            inner = f"SELECT {cols}, spot, {move} FROM ({inner}) s{i}"
        done = "spot < nw" if w else "false"
        steps.append(f"g{w + 1} AS MATERIALIZED (SELECT {cols}, CASE WHEN {done} THEN spot ELSE c * b + d END AS spot FROM ({inner}) s)")
    return ",\n".join(steps) + f",\nr AS (SELECT {', '.join(['win_id', *group, 'nw'])}, spot AS rk FROM g{walks})"


def packed(b: int, tok: str = "tok") -> str:
    return f"""packed AS (
  SELECT a.blk AS win_id, a.x, b.y FROM
   (SELECT pos // {b} AS blk, list(id ORDER BY pos) AS x FROM {tok} GROUP BY 1) a
   JOIN (SELECT (pos - 1) // {b} AS blk, list(id ORDER BY pos) AS y FROM {tok} WHERE pos >= 1 GROUP BY 1) b
   ON a.blk = b.blk
  WHERE len(a.x) = {b} AND len(b.y) = {b})"""


PRETOK_DUCK = (f"'s|'t|'re|'ve|'m|'ll|'d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{WHITE_SPACE}\\p{{L}}\\p{{N}}\\x01]+"
               f"|[{WHITE_SPACE}]+")
_LAST_BLANK = f"([{WHITE_SPACE}]+)([{WHITE_SPACE}][^{WHITE_SPACE}])"


def words_cte(src: str = "documents") -> str:
    return f"""d1 AS (SELECT {strip('text')} AS t FROM {src}),
d2 AS (SELECT regexp_replace(t, {q(_LAST_BLANK)}, '\\1' || chr(1) || '\\2', 'g') AS t FROM d1 WHERE length(t) > 0),
wd AS (SELECT unnest(regexp_extract_all(t, {q(PRETOK_DUCK)})) AS word FROM d2),
hist AS (SELECT word, count(*)::BIGINT AS n FROM wd GROUP BY 1)"""


def _fim_sql(b: int, seed: int) -> str:
    n = b
    s = str(seed)
    a = f"(1 + {h32(s, 'win_id', '1')} % {n - 2})"
    return f"""fimc AS (
  SELECT win_id, x, {uni(s, 'win_id', '0')} < 0.5 AS do_fim,
         {a} AS a, {uni(s, 'win_id', '3')} < 0.5 AS spm FROM packed),
fimb AS (SELECT *, a + 1 + {h32(s, 'win_id', '2')} % ({n - 1} - a) AS b FROM fimc),
fims AS (
  SELECT win_id, CASE WHEN NOT do_fim THEN x
    WHEN spm THEN list_concat([5], x[b + 1:{n}], [4], x[1:a], [6], x[a + 1:b], [3])
    ELSE list_concat([4], x[1:a], [5], x[b + 1:{n}], [6], x[a + 1:b], [3]) END AS s
  FROM fimb),
fim AS (SELECT win_id, s[1:len(s) - 1] AS input_ids, s[2:len(s)] AS labels FROM fims)"""


SQL = {
    "discover_filtered": discover_tree("substring"),
    "discover_glob": discover_tree("glob"),
    "ext_histogram": f"WITH {discovered()} SELECT ext, count(*)::BIGINT AS n_files FROM disc GROUP BY ext",
    "corpus_totals": f"""WITH {discovered()} SELECT count(*)::BIGINT AS total_files,
        coalesce(sum(n_bytes), 0)::BIGINT AS total_bytes,
        sum(CASE WHEN text IS NULL OR length({strip('text')}) = 0 THEN 1 ELSE 0 END)::BIGINT AS skipped_files
        FROM disc""",
    "strip_nonempty": f"""SELECT conv_id, turn, t AS text, length(t) AS n_chars
        FROM (SELECT conv_id, turn, {strip('text')} AS t FROM conversations) c WHERE length(t) > 0""",
    "compose_pairs": """SELECT u.conv_id, u.turn,
        CASE WHEN length(u.text) > 0 THEN '\"\"\"' || chr(10) || u.text || chr(10) || '\"\"\"' || chr(10) || a.text
             ELSE a.text END AS content
        FROM conversations u JOIN conversations a
          ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
        WHERE u.role = 'user' AND a.role = 'assistant'""",
    "file_names": f"""WITH {FILES} SELECT doc_id, source || '/' || lang || '/' || printf('%08d', doc_id) || ext AS file_name FROM files""",
    "quota_files": f"""WITH {FILES}, s AS (SELECT doc_id, source, strlen({strip('text')})::BIGINT AS n_bytes FROM files),
        r AS (SELECT *, count(*) OVER w - 1 AS fb FROM s WHERE n_bytes > 0
              WINDOW w AS (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
        SELECT doc_id, source, n_bytes FROM r WHERE fb < 30""",
    "quota_bytes": f"""WITH {FILES}, s AS (SELECT doc_id, source, strlen({strip('text')})::BIGINT AS n_bytes FROM files),
        r AS (SELECT *, coalesce(sum(n_bytes) OVER (PARTITION BY source ORDER BY doc_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bb FROM s WHERE n_bytes > 0)
        SELECT doc_id, source, n_bytes FROM r WHERE bb < 60000""",
    "union_sources": f"""WITH u AS (
          SELECT 'documents' AS dataset, doc_id AS idx, {strip('text')} AS c FROM documents
          UNION ALL SELECT 'benchmark', item_id, {strip('text')} FROM benchmark
          UNION ALL SELECT 'pages', page_id, {strip('html')} FROM pages),
        s AS (SELECT dataset, idx, strlen(c)::BIGINT AS n_bytes FROM u WHERE length(c) > 0),
        r AS (SELECT *, count(*) OVER w - 1 AS fb,
                 coalesce(sum(n_bytes) OVER w - n_bytes, 0) AS bb FROM s
              WINDOW w AS (PARTITION BY dataset ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
        SELECT dataset, idx, n_bytes FROM r WHERE fb < 400 AND bb < 2000000""",
    "tag_lookup": f"""WITH {FILES} SELECT doc_id, ext, {_TAG_NAME} AS tag, ({_TAG_CASE})::INTEGER AS tag_id FROM files""",
    "missing_specials": f"""WITH {words_cte()},
        v AS (SELECT ltrim(word, ' ') AS token FROM hist UNION ALL SELECT unnest([{', '.join(q(t) for t in CORE_SPECIALS)}])),
        wanted AS (SELECT unnest([{', '.join(q(t) for t in SPECIALS)}]) AS token
                   UNION SELECT unnest(regexp_extract_all(text, '[^ \\t\\n\\r\\f]+')) FROM benchmark)
        SELECT token FROM wanted WHERE token NOT IN (SELECT token FROM v)""",
    "word_histogram": f"WITH {words_cte()} SELECT word, n FROM hist",
    "stream_offsets": f"WITH {STREAM} SELECT doc_id, start_off, len(ids)::BIGINT AS n_tokens FROM stream",
    "split_tail": f"""WITH {STREAM},
        cut AS (SELECT n - greatest(1, floor(n * {VAL_RATIO})::BIGINT) AS n_train FROM ntok),
        k AS (SELECT doc_id, start_off, ids, least(greatest(n_train - start_off, 0), len(ids)) AS k, n_train
              FROM stream, cut)
        SELECT 'train' AS split, doc_id, start_off, k::BIGINT AS n_tokens, ids[1:k] AS ids FROM k WHERE k > 0
        UNION ALL
        SELECT 'val', doc_id, start_off + k - n_train, (len(ids) - k)::BIGINT, ids[k + 1:len(ids)] FROM k WHERE k < len(ids)""",
    "split_hash": f"""WITH {STREAM}
        SELECT CASE WHEN {uni('42', 'doc_id')} < 0.1 THEN 'val' ELSE 'train' END AS split,
               count(*)::BIGINT AS n_docs, sum(len(ids))::BIGINT AS n_tokens
        FROM stream GROUP BY 1""",
    "meta_row": f"""WITH {STREAM},
        per AS (SELECT ext, count(*)::BIGINT AS n_files,
                  sum(CASE WHEN length({strip('text')}) = 0 THEN 1 ELSE 0 END)::BIGINT AS n_skip
                FROM disc GROUP BY ext)
        SELECT 30100::BIGINT AS vocab_size, n AS total_tokens,
               n - greatest(1, floor(n * {VAL_RATIO})::BIGINT) AS train_tokens,
               greatest(1, floor(n * {VAL_RATIO})::BIGINT) AS val_tokens,
               {VAL_RATIO}::DOUBLE AS val_ratio, 'uint16' AS dtype,
               (SELECT sum(n_files) FROM per)::BIGINT AS total_files,
               (SELECT sum(n_skip) FROM per)::BIGINT AS skipped_files,
               (SELECT string_agg(ext || '=' || n_files, ',' ORDER BY ext) FROM per) AS ext_counts
        FROM ntok""",
    "windows_packed": f"WITH {STREAM}, {packed(128)} SELECT win_id, x, y FROM packed",
    "windows_stride": f"""WITH {STREAM},
        w AS (SELECT pos AS win_id,
                list(id) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND 15 FOLLOWING) AS x,
                list(id) OVER (ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 16 FOLLOWING) AS y
              FROM tok)
        SELECT win_id, x, y FROM w, ntok WHERE win_id + 16 < n""",
    "train_batches": f"""WITH {SPLIT}, {packed(61, 'tok_train')}, {permuted('packed', str(TRAIN_SHUFFLE_SEED))}
        SELECT win_id, (rk // 8)::BIGINT AS batch_id, (rk % 8)::INTEGER AS "row" FROM r WHERE rk < (nw // 8) * 8""",
    "val_batches": f"""WITH {SPLIT}, {packed(61, 'tok_val')}
        SELECT (win_id // 8)::BIGINT AS batch_id, (win_id % 8)::INTEGER AS "row", win_id, x, y FROM packed""",
    "fim_samples": f"WITH {SPLIT}, {packed(61, 'tok_train')}, {_fim_sql(61, 42)} SELECT win_id, input_ids, labels FROM fim",
    "collated_batches": f"""WITH {SPLIT}, {packed(61, 'tok_train')}, {_fim_sql(61, 42)},
        {permuted('packed', str(TRAIN_SHUFFLE_SEED))},
        b AS (SELECT rk // 8 AS batch_id, rk % 8 AS "row", fim.win_id, input_ids, labels,
                len(input_ids) AS ln, max(len(input_ids)) OVER (PARTITION BY rk // 8) AS mx
              FROM fim JOIN r ON r.win_id = fim.win_id WHERE rk < (nw // 8) * 8)
        SELECT batch_id::BIGINT AS batch_id, "row"::INTEGER AS "row", win_id,
          list_concat(input_ids, list_transform(range(mx - ln), lambda i: 1)) AS input_ids,
          list_concat(labels, list_transform(range(mx - ln), lambda i: -100)) AS labels,
          list_concat(list_transform(range(ln), lambda i: 1), list_transform(range(mx - ln), lambda i: 0)) AS attention_mask
        FROM b""",
    "fim_prompt": """SELECT item_id, '<fim_prefix>' || substr(text, 1, floor(length(text) / 2)::BIGINT)
        || '<fim_suffix>' || substr(text, floor(length(text) / 2)::BIGINT + 1) || '<fim_middle>' AS prompt
        FROM benchmark""",
}

SAMPLES = """samples AS (SELECT d.source AS task_id, l.doc_id AS sample_id, l.quality = 1 AS passed
                    FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""
PER_TASK = f"""{SAMPLES}, per AS (SELECT task_id, count(*)::BIGINT AS n_samples,
                       sum(passed::INTEGER)::BIGINT AS n_correct FROM samples GROUP BY 1)"""
PASSK = """CASE WHEN n_samples - n_correct < k THEN 1.0
          ELSE 1.0 - exp(list_sum(list_transform(range(k), lambda i: ln(n_samples - n_correct - i) - ln(n_samples - i)))) END"""

NEXT_PAIRS = f"""{STREAM},
cut AS (SELECT n - greatest(1, floor(n * {VAL_RATIO})::BIGINT) AS n_train FROM ntok),
pairs AS (SELECT t2.pos, t1.id AS ctx, t2.id AS nxt FROM tok t1 JOIN tok t2 ON t2.pos = t1.pos + 1),
counts AS (SELECT ctx, nxt, count(*)::BIGINT AS n FROM pairs, cut WHERE pos < n_train GROUP BY 1, 2),
totals AS (SELECT ctx, sum(n) AS t FROM counts GROUP BY 1),
tl AS (SELECT p.pos, -ln((coalesce(c.n, 0) + 1.0) / (coalesce(tt.t, 0) + 1.0 * 30100)) AS loss,
              (p.pos - cut.n_train - 1) // 64 AS batch_id
       FROM pairs p CROSS JOIN cut LEFT JOIN counts c ON c.ctx = p.ctx AND c.nxt = p.nxt
       LEFT JOIN totals tt ON tt.ctx = p.ctx WHERE p.pos > cut.n_train)"""

CANDS = """cands AS (SELECT l_suppkey AS ctx, l_partkey AS token, sum(l_quantity - 25) / 10 AS logit
                  FROM lineitem GROUP BY 1, 2)"""


def _softmax(src: str, out: str) -> str:
    return f"""SELECT *, e / sum(e) OVER (PARTITION BY ctx) AS {out}
        FROM (SELECT *, exp(logit - max(logit) OVER (PARTITION BY ctx)) AS e FROM {src}) z"""


PRUNED_CTES = f"""tk AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY ctx ORDER BY logit DESC) AS rk FROM cands) r WHERE rk <= 50),
tkp AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY ctx)) AS e FROM tk),
tkq AS (SELECT *, e / sum(e) OVER (PARTITION BY ctx) AS p FROM tkp),
nuc AS (SELECT ctx, token, logit FROM (SELECT *, coalesce(sum(p) OVER (PARTITION BY ctx ORDER BY logit DESC, token
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM tkq) z WHERE before <= 0.9),
nuce AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY ctx)) AS e FROM nuc),
pruned AS (SELECT ctx, token, logit, e / sum(e) OVER (PARTITION BY ctx) AS prob FROM nuce)"""

PRUNED = f"{CANDS},\n{PRUNED_CTES}"

RUNLOG = """runlog AS (SELECT event_type AS run_id, event_id AS raw_step, ts, value / 100 AS loss,
                   2048::BIGINT AS tokens FROM events)"""

SQL.update({
    "correct_per_task": f"WITH {PER_TASK} SELECT * FROM per",
    "pass_at_k": f"""WITH {PER_TASK}, kk AS (SELECT unnest([1, 5, 10]) AS k)
        SELECT k, round(avg({PASSK}), 6) AS pass_at_k, count(*)::BIGINT AS n_tasks
        FROM per, kk WHERE k <= n_samples GROUP BY k""",
    "validity_rate": f"""WITH {PER_TASK} SELECT task_id, n_samples AS n_total, n_correct AS n_valid,
        round(n_correct / n_samples, 6) AS pass_rate FROM per""",
    "completions": """SELECT u.conv_id, u.turn, split_part(a.text, chr(10) || chr(10), 1) AS completion,
          length(u.text || split_part(a.text, chr(10) || chr(10), 1)) AS full_len
        FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
        WHERE u.role = 'user' AND a.role = 'assistant'""",
    "ngram_counts": f"WITH {NEXT_PAIRS} SELECT ctx, nxt, n FROM counts",
    "trigram_counts": f"""WITH {SPLIT}
        SELECT a.id::BIGINT * {_ID_SPAN} + b.id AS ctx, c.id AS nxt, count(*)::BIGINT AS n
        FROM tok_train a JOIN tok_train b ON b.pos = a.pos + 1 JOIN tok_train c ON c.pos = a.pos + 2 GROUP BY 1, 2""",
    "fivegram_counts": f"WITH {SPLIT} {_ngrams(5)}",
    "ngram_levels": f"""WITH {SPLIT} SELECT 4 AS order_n, * FROM ({_ngrams(4)}) a
        UNION ALL SELECT 3, * FROM ({_ngrams(3)}) b UNION ALL SELECT 2, * FROM ({_ngrams(2)}) c""",
    "ngram_sample": f"""WITH {NEXT_PAIRS}, cands AS (SELECT ctx, nxt AS token, ln(n) AS logit FROM counts), {PRUNED_CTES}
        SELECT ctx, arg_max(token, ln(prob) - ln(-ln(({h32('7', 'ctx', 'token')} + 0.5) / 4294967296.0))) AS token
        FROM pruned GROUP BY ctx""",
    "val_loss_batch": f"""WITH {NEXT_PAIRS}, mb AS (SELECT unnest([20, 50, 0]) AS max_batches),
        per AS (SELECT max_batches, batch_id, avg(loss) AS bl FROM tl, mb WHERE (max_batches = 0 OR batch_id < max_batches) GROUP BY 1, 2)
        SELECT max_batches, round(avg(bl), 6) AS loss, count(*)::BIGINT AS n FROM per GROUP BY 1""",
    "val_loss_token": f"""WITH {NEXT_PAIRS}, mb AS (SELECT unnest([20, 50, 0]) AS max_batches)
        SELECT max_batches, round(avg(loss), 6) AS loss, count(*)::BIGINT AS n
        FROM tl, mb WHERE (max_batches = 0 OR batch_id < max_batches) GROUP BY 1""",
    "perplexity": """WITH l AS (SELECT event_type, 'mean_scaled' AS measure, avg(value) / 100 AS loss FROM events GROUP BY 1
          UNION ALL SELECT event_type, 'max_raw', max(value) FROM events GROUP BY 1)
        SELECT event_type, measure, round(loss, 6) AS loss,
          CASE WHEN loss < 300 THEN round(exp(loss), 6) ELSE 'inf'::DOUBLE END AS perplexity FROM l""",
    "softmax": f"WITH {CANDS}, s AS ({_softmax('cands', 'prob')}) SELECT ctx, token, round(prob, 6) AS prob FROM s",
    "topk_ties": f"""WITH {CANDS} SELECT ctx, token, logit FROM
        (SELECT *, rank() OVER (PARTITION BY ctx ORDER BY logit DESC) AS rk FROM cands) r WHERE rk <= 3""",
    "nucleus": f"WITH {PRUNED} SELECT ctx, token, round(prob, 6) AS prob FROM pruned",
    "penalised": f"""WITH {CANDS}, seen AS (SELECT DISTINCT l_suppkey AS ctx, l_partkey AS token FROM lineitem WHERE l_returnflag = 'R')
        SELECT c.ctx, c.token,
          round(CASE WHEN s.ctx IS NOT NULL THEN c.logit / 1.3 ELSE c.logit END / 0.7, 6) AS logit_divide,
          round(CASE WHEN s.ctx IS NOT NULL THEN (CASE WHEN c.logit > 0 THEN c.logit / 1.3 ELSE c.logit * 1.3 END)
                ELSE c.logit END / 0.7, 6) AS logit_signed
        FROM cands c LEFT JOIN seen s ON s.ctx = c.ctx AND s.token = c.token""",
    "sample_next": f"""WITH {PRUNED}
        SELECT ctx, arg_max(token, ln(prob) - ln(-ln(({h32('7', 'ctx', 'token')} + 0.5) / 4294967296.0))) AS token
        FROM pruned GROUP BY ctx""",
    "step_rollup": f"""WITH {RUNLOG}
        SELECT run_id, step, round(arg_max(loss, raw_step), 6) AS loss,
               count(*)::BIGINT AS n_micro, sum(tokens)::BIGINT AS tokens
        FROM (SELECT *, (row_number() OVER (PARTITION BY run_id ORDER BY raw_step) + 15) // 16 AS step FROM runlog) z
        GROUP BY 1, 2 HAVING step % 10 = 0 AND count(*) = 16""",
    "throughput": f"""WITH {RUNLOG},
        c AS (SELECT run_id, raw_step, sum(tokens) OVER (PARTITION BY run_id ORDER BY raw_step
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS tokens_so_far,
                 (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY run_id))) / 1e6 AS el FROM runlog)
        SELECT run_id, raw_step, tokens_so_far, round(el, 6) AS elapsed_s,
               round(CASE WHEN el > 0 THEN tokens_so_far / el END, 6) AS tok_per_s FROM c""",
    "retention": f"""WITH {RUNLOG}, m AS (SELECT run_id, printf('step_%07d', raw_step) AS name, raw_step::INTEGER AS step FROM runlog)
        SELECT run_id, name, step FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS rn FROM m) z
        WHERE rn <= 3""",
})

_BYTES = "list_transform(range(strlen(word)), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::INTEGER)"

SQL.update({
    "pair_counts": f"""WITH {words_cte()},
        b AS (SELECT {_BYTES} AS bs, n FROM hist),
        p AS (SELECT bs[i] AS left_byte, bs[i + 1] AS right_byte, n
              FROM (SELECT bs, n, unnest(range(1, len(bs))) AS i FROM b) z)
        SELECT left_byte, right_byte, sum(n)::BIGINT AS n FROM p GROUP BY 1, 2""",
    "alphabet": f"""WITH {words_cte()},
        b AS (SELECT unnest({_BYTES}) AS byte, n FROM hist)
        SELECT byte, sum(n)::BIGINT AS n FROM b GROUP BY 1""",
    "bpe_roundtrip": f"""SELECT doc_id, {strip('text')} AS text FROM documents
        WHERE length({strip('text')}) > 0""",
})

def bpe_ctes(merges: int) -> str:
    """One step of SQL per merge over the word histogram: count the adjacent
    pairs, take the first by count and ids, rewrite the words.  A symbol is
    written with a space on either side, so a pair is a plain substring.
    Words of the benchmark take part with weight 0.  Ends with seg (word,
    ids) and ranked (rank, left_id, right_id, merged_id)."""
    first = len(SPECIALS) + 256
    ids = ", ".join(str(i) for i in byte_ids(len(SPECIALS)))
    steps = [f"""{words_cte()},
bw AS (SELECT DISTINCT unnest(regexp_extract_all(t, {q(PRETOK_DUCK)})) AS word
       FROM (SELECT regexp_replace({strip('text')}, {q(_LAST_BLANK)}, '\\1' || chr(1) || '\\2', 'g') AS t FROM benchmark) z),
allw AS (SELECT word, n FROM hist UNION ALL SELECT word, 0 FROM bw WHERE word NOT IN (SELECT word FROM hist)),
w0 AS MATERIALIZED (SELECT word, n, array_to_string(list_transform({_BYTES},
       lambda b: ' ' || list_extract([{ids}], b + 1) || ' '), '') AS syms FROM allw)"""]
    for k in range(merges):
        steps.append(f"""p{k} AS MATERIALIZED (SELECT s[i]::INT AS l, s[i + 1]::INT AS r, sum(n) AS c FROM (
         SELECT n, s, unnest(range(1, len(s))) AS i FROM (
           SELECT n, regexp_extract_all(syms, '[0-9]+') AS s FROM w{k} WHERE n > 0) y) z
       GROUP BY 1, 2 HAVING sum(n) >= 2 ORDER BY c DESC, l, r LIMIT 1),
w{k + 1} AS MATERIALIZED (SELECT word, n, replace(syms, ' ' || l || '  ' || r || ' ', ' {first + k} ') AS syms FROM w{k}, p{k})""")
    steps.append("ranked AS (" + " UNION ALL ".join(
        f"SELECT {k} AS rank, l AS left_id, r AS right_id, {first + k} AS merged_id FROM p{k}"
        for k in range(merges)) + ")")
    steps.append(f"seg AS MATERIALIZED (SELECT word, list_transform(regexp_extract_all(syms, '[0-9]+'), "
                 f"lambda x: x::INT) AS ids FROM w{merges})")
    return ",\n".join(steps)


def bpe_words(text: str, key: str, src: str) -> str:
    """(key, ids) of every non-blank text of a table."""
    return f"""(SELECT {key}, flatten(list(seg.ids ORDER BY i)) AS ids FROM (
        SELECT {key}, ws[i] AS word, i FROM (
          SELECT {key}, ws, unnest(range(1, len(ws) + 1)) AS i FROM (
            SELECT {key}, regexp_extract_all(regexp_replace({strip(text)}, {q(_LAST_BLANK)}, '\\1' || chr(1) || '\\2', 'g'),
                   {q(PRETOK_DUCK)}) AS ws FROM {src}) a) b) c JOIN seg USING (word) GROUP BY {key})"""


BPE = bpe_ctes(QUERY_MERGES)
_TOKENS = ", ".join(q(t) for t in [*SPECIALS, *ALPHABET])
BPE_STREAM = f"""{discovered()}, {BPE},
enc AS {bpe_words('text', 'doc_id', 'disc')},
seq AS (SELECT doc_id, path,
          list_concat(CASE WHEN {_TAG_CASE} IS NULL THEN []::INTEGER[] ELSE [({_TAG_CASE})::INTEGER] END,
                      enc.ids, [{EOT_ID}::INTEGER]) AS ids FROM disc JOIN enc USING (doc_id)),
stream""" + STREAM.split("\nstream", 1)[1]
BPE_SPLIT = BPE_STREAM + SPLIT[len(STREAM):]

SQL.update({
    # token strings grow with the merges, so they are followed in rank order
    "bpe_merges_48": f"""WITH RECURSIVE {BPE},
        grown AS (
          SELECT 0 AS rank, [{_TOKENS}] AS tokens
          UNION ALL
          SELECT g.rank + 1, list_append(tokens, tokens[left_id + 1] || tokens[right_id + 1])
          FROM grown g JOIN ranked r ON r.rank = g.rank)
        SELECT rank::INTEGER AS rank, tokens[left_id + 1] AS "left", tokens[right_id + 1] AS "right",
               tokens[merged_id + 1] AS merged, left_id, right_id, merged_id::INTEGER AS merged_id
        FROM ranked, (SELECT tokens FROM grown ORDER BY rank DESC LIMIT 1) t""",
    "bpe_encode_48": f"""WITH {BPE} SELECT doc_id, len(ids)::BIGINT AS n_tokens, ids
        FROM {bpe_words('text', 'doc_id', 'documents')} e""",
    "bpe_roundtrip_48": SQL["bpe_roundtrip"],
    "prompt_encode_48": f"""WITH {BPE} SELECT item_id, CASE WHEN ids IS NULL THEN [2] ELSE list_concat([2], ids, [3]) END AS ids
        FROM benchmark LEFT JOIN {bpe_words('text', 'item_id', 'benchmark')} e USING (item_id)""",
    "token_shards_48": SQL["split_tail"].replace(f"WITH {STREAM}", f"WITH {BPE_STREAM}"),
    "train_samples_48": SQL["collated_batches"].replace(f"WITH {SPLIT}", f"WITH {BPE_SPLIT}"),
    "val_samples_48": SQL["val_batches"].replace(f"WITH {SPLIT}", f"WITH {BPE_SPLIT}"),
})

SQL.update({
    "ingest_available_now": SQL["quota_files"],
    "ingest_counts": f"""SELECT lang, count(*)::BIGINT AS n_rows, sum(strlen(t))::BIGINT AS n_bytes
        FROM (SELECT lang, {strip('text')} AS t FROM documents) d WHERE length(t) > 0 GROUP BY lang""",
})

SQL.update({
    "train_epochs": f"""WITH {SPLIT}, {packed(61, 'tok_train')},
        ep AS (SELECT win_id, unnest([0, 1]) AS epoch FROM packed),
        {permuted('ep', str(TRAIN_SHUFFLE_SEED), 'epoch')}
        SELECT epoch, win_id, (epoch * (nw // 8) + rk // 8)::BIGINT AS batch_id, (rk % 8)::INTEGER AS "row" FROM r
        WHERE rk < (nw // 8) * 8""",
})

SQL.update({
    "task_progress": f"""WITH {PER_TASK}
        SELECT task_id, row_number() OVER (ORDER BY task_id)::BIGINT AS position,
               count(*) OVER ()::BIGINT AS total,
               round(CASE WHEN n_samples - n_correct < 1 THEN 1.0
                     ELSE 1.0 - exp(ln(n_samples - n_correct) - ln(n_samples)) END, 6) AS pass_at_1
        FROM per""",
    "doc_index": f"""WITH {discovered()}
        SELECT doc_id, (row_number() OVER (ORDER BY string_split(path, '/')) - 1)::BIGINT AS idx FROM disc""",
})

SQL.update({
    "sample_grid": """SELECT item_id AS task_id, unnest(range(20))::INTEGER AS sample_id FROM benchmark""",
})

META = SQL["meta_row"]
SQL.update({
    "quota_languages": f"""WITH s AS (SELECT lang, list_position([{', '.join(q(x) for x in LANG_TO_EXT)}], lang) - 1 AS lang_rank,
          doc_id AS idx, strlen({strip('text')})::BIGINT AS n_bytes FROM documents),
        r AS (SELECT *, coalesce(sum(n_bytes) OVER (ORDER BY lang_rank, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bb
              FROM s WHERE n_bytes > 0 AND lang_rank IS NOT NULL)
        SELECT lang AS language, idx, n_bytes FROM r WHERE bb < 1000000""",
    "corpus_scan": f"""SELECT doc_id AS idx, length({strip('text')}) AS n_chars FROM documents WHERE length({strip('text')}) > 0""",
    "documents_sink": f"""WITH {FILES} SELECT source AS dataset, lang, doc_id AS idx,
          source || '/' || lang || '/' || printf('%08d', doc_id) || ext AS path, length(text) AS n_chars FROM files""",
    "jsonl_scan": "SELECT item_id::VARCHAR AS task_id, text AS prompt FROM benchmark",
    "prompts_scan": f"""SELECT p AS prompt, count(*)::BIGINT AS n FROM (
          SELECT {strip('l')} AS p FROM (SELECT unnest(string_split(text, chr(10))) AS l FROM benchmark) a) b
        WHERE length(p) > 0 GROUP BY 1""",
    "function_pairs": SQL["compose_pairs"],
    "meta_sink": f"""SELECT vocab_size, total_tokens, train_tokens, val_tokens, val_ratio, dtype, tokenizer,
          total_files, skipped_files, ext_counts FROM (SELECT *, 'word-hash' AS tokenizer FROM ({META}) m) z""",
    "completions_sink": """SELECT '=== PROMPT: ' || u.text || ' ===' || chr(10)
          || string_agg(a.text, chr(10) || chr(10) ORDER BY a.turn, a.text) AS value
        FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
        WHERE u.role = 'user' AND a.role = 'assistant' GROUP BY u.text""",
    "report_sink": f"""WITH {PER_TASK} SELECT sum(n_correct)::BIGINT AS n_valid, sum(n_samples)::BIGINT AS n_total,
          round(sum(n_correct) / sum(n_samples), 6) AS pass_rate,
          (SELECT round(avg({PASSK}), 6) FROM per, (SELECT 5 AS k) kk WHERE k <= n_samples) AS pass_at_5,
          (SELECT round(avg(value) / 100, 6) FROM events) AS loss FROM per""",
    "top_extensions": f"""WITH {discovered()} SELECT ext, count(*)::BIGINT AS n_files FROM disc GROUP BY ext
        ORDER BY n_files DESC, ext LIMIT 15""",
})

_TREE = """tree AS (SELECT lang, doc_id // 100 AS bucket, doc_id, text, length(text) % 97 = 0 AS bad FROM documents WHERE lang <> 'es'),
        sized AS (SELECT lang, bucket FROM tree GROUP BY ALL HAVING sum(strlen(text) + 1 + bad::INTEGER) BETWEEN 2000 AND {most})"""
_TREE_FILE = """regexp_replace(string_agg(text || CASE WHEN bad THEN chr(65533) ELSE '' END || chr(10), '' ORDER BY doc_id),
          '\r\n?', chr(10), 'g')"""
TREE_CTE = _TREE.format(most=MAX_FILE_BYTES)
SQL.update({
    "quota_first_files": f"""WITH s AS (SELECT doc_id, strlen({strip('text')})::BIGINT AS n_bytes FROM documents),
        r AS (SELECT *, coalesce(sum(n_bytes) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bb
              FROM s WHERE n_bytes > 0)
        SELECT doc_id, n_bytes FROM r WHERE bb < 200000""",
    "discover_tree": f"""WITH {TREE_CTE} SELECT lang, bucket, '.txt' AS ext,
          sum(strlen(text) + 1 + bad::INTEGER)::BIGINT AS n_bytes FROM tree JOIN sized USING (lang, bucket) GROUP BY lang, bucket""",
    "decode_tree": f"""WITH {TREE_CTE} SELECT lang, bucket, NOT bool_or(bad) AS valid,
          CASE WHEN NOT bool_or(bad) THEN length({_TREE_FILE})::BIGINT END AS n_chars
        FROM tree JOIN sized USING (lang, bucket) GROUP BY lang, bucket""",
    "tree_lines": f"""WITH {TREE_CTE}, f AS (SELECT lang, bucket, {_TREE_FILE} AS t FROM tree JOIN sized USING (lang, bucket) GROUP BY lang, bucket)
        SELECT lang, bucket, len(string_split(t, chr(10)))::BIGINT AS n_lines, length(replace(t, chr(10), ''))::BIGINT AS n_chars,
               (length(t) - length(replace(t, chr(65533), '')))::BIGINT AS n_bad FROM f""",
    "new_tokens": f"WITH {STREAM} SELECT doc_id, ids[len(ids) // 2 + 1:] AS ids FROM seq",
    "resolved_ids": f"""WITH {FILES} SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 2 = 0 THEN doc_id % 3 END, 0),
          nullif(({_TAG_CASE})::BIGINT, 0), 7)::INTEGER AS id FROM files""",
    "windows_at": f"""WITH {STREAM},
        w AS (SELECT pos AS start,
                list(id) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND 60 FOLLOWING) AS x,
                list(id) OVER (ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 61 FOLLOWING) AS y FROM tok)
        SELECT start, x, y FROM w, ntok WHERE start + 61 < n AND start IN (SELECT start_off FROM stream)""",
})
