"""Independent SQL statements for the registered queries, in the DuckDB dialect.

They state each result in the plainest relational form (global window
functions, full un-nesting) and share nothing with the Spark jobs but the
table mapping.
"""

from __future__ import annotations

from braidwork.configs import (
    DEFAULT_DELIMITER,
    TOKENIZER_NAMES,
    ModelConfig,
    TrainingConfig,
)
from braidwork.functions.text import WHITESPACE_CODEPOINTS

END = DEFAULT_DELIMITER
WS = "||".join(f"chr({c})" for c in WHITESPACE_CODEPOINTS)
END_HEX = END.encode().hex().upper()


def _trim(expr: str) -> str:
    return f"trim({expr}, {WS})"


def _bytes(expr: str) -> str:
    return (
        f"list_transform(regexp_extract_all(hex(encode({expr})), '{END_HEX}|..'), "
        f"lambda p: CASE WHEN length(p) > 2 THEN 256 ELSE ('0x' || p)::INT END)"
    )


def _csv(expr: str) -> str:
    return f"array_to_string({expr}, ',')"


def _uniform(*parts: str) -> str:
    key = " || ':' || ".join(f"({p})::VARCHAR" for p in parts)
    return f"((('0x' || substr(md5({key}), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)"


CLEAN = f"""clean AS (
  SELECT doc_id, {_trim('text')} || '{END}' AS text FROM documents WHERE {_trim('text')} <> '')"""

PADDED = f"""padded AS (
  SELECT doc_id, {_trim("'  ' || chr(9) || text || ' ' || chr(28) || chr(10)")} || '{END}' AS text
  FROM documents WHERE {_trim('text')} <> '')"""


def _rows(maxlen: int) -> str:
    return f"""{CLEAN}, rows AS (
  SELECT doc_id, list_resize({_bytes('text')}, {maxlen}, 0) AS x FROM clean)"""


def _windows(maxlen: int) -> str:
    """Whole documents in windows."""
    return f"""{CLEAN}, doc_tokens AS (SELECT doc_id, {_bytes('text')} AS t FROM clean),
rows AS (
  SELECT doc_id, w::INT AS "window", list_resize(t[w * {maxlen} + 1:w * {maxlen} + {maxlen}], {maxlen}, 0) AS x
  FROM (SELECT doc_id, t, unnest(range(0, (len(t) + {maxlen} - 1) // {maxlen})) AS w FROM doc_tokens))"""


def _shifted(x: str = "x") -> str:
    return f"list_append({x}[2:], 0)"


WORDS = f"""{CLEAN}, words AS (
  SELECT doc_id, regexp_extract_all(replace(text, '{END}', ' {END} '), '[^ \\t\\n\\r\\f\\x0b]+') AS w
  FROM clean),
placed AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM words),
counted AS (SELECT token, count(*) AS n FROM placed GROUP BY token),
vocab AS (SELECT row_number() OVER (ORDER BY n DESC, token) AS token_id, token, n FROM counted)"""

ORDERED = """ordered AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS ix, count(*) OVER () AS n FROM documents)"""

STEPS = """numbered AS (
  SELECT user_id AS run_id, value AS loss,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS s FROM events),
steps AS (
  SELECT run_id, (s // 25 + 1)::INT AS epoch, (s % 25)::INT AS step, loss FROM numbered),
flagged AS (
  SELECT *, (step + 1) % 4 = 0 AS closes,
         coalesce(sum(CASE WHEN (step + 1) % 4 = 0 THEN 1 ELSE 0 END) OVER (
           PARTITION BY run_id ORDER BY epoch, step
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS g FROM steps),
windows AS (
  SELECT run_id, g, arg_max(epoch, epoch * 1000 + step) AS end_epoch,
         arg_max(step, epoch * 1000 + step) AS end_step,
         count(*) AS n_losses, avg(loss) AS window_mean
  FROM flagged GROUP BY run_id, g HAVING bool_or(closes))"""

LR = """CASE WHEN {step} < warmup_steps THEN lr_peak * {step} / warmup_steps
  ELSE floor_rate + (lr_peak - floor_rate) * 0.5::DOUBLE * (1.0::DOUBLE + cos(pi() *
    least({step} - warmup_steps, total_steps - warmup_steps)::DOUBLE / (total_steps - warmup_steps)))
  END"""

CUSTOMER_PLAN = """planned AS (
  SELECT c_custkey AS run_id, c_custkey % 40 AS n_batches,
         ((c_custkey % 40) * (1 + c_nationkey % 5))::BIGINT AS total,
         (c_custkey % 11) / 10.0::DOUBLE AS rate,
         0.001::DOUBLE * (c_custkey % 7) AS lr_peak,
         CASE WHEN c_custkey % 7 = 0 THEN 0.0::DOUBLE ELSE 0.00001::DOUBLE END AS floor_rate
  FROM customer),
plan AS (
  SELECT run_id, n_batches, lr_peak, floor_rate,
         CASE WHEN n_batches > 0 THEN total ELSE -1 END AS total_steps,
         CASE WHEN n_batches > 0 THEN greatest(1, trunc(total * rate)::BIGINT) ELSE -1 END AS warmup_steps
  FROM planned),
status AS (
  SELECT *, CASE WHEN n_batches <= 0 THEN 'no_batches'
                 WHEN warmup_steps >= total_steps THEN 'no_decay_steps' ELSE 'ok' END AS status FROM plan)"""

WEIGHTS = """w AS (
  SELECT 'leaf_' || vec_id AS leaf, label, unnest(embedding)::DOUBLE AS v,
         generate_subscripts(embedding, 1) AS i FROM embeddings),
pair AS (
  SELECT leaf, label, i, CASE WHEN label = 5 THEN 0.0::DOUBLE ELSE v END AS b,
         v * (1.0::DOUBLE + label * 0.01::DOUBLE) AS a FROM w),
norms AS (
  SELECT leaf, count(*) AS n_values, sqrt(sum(b * b)) AS nb, sqrt(sum(a * a)) AS na FROM pair GROUP BY leaf),
diffs AS (SELECT leaf, abs(b - a) AS d FROM pair)"""

RATIO_SUMMARY = """SELECT round(coalesce(median(r), 0), 6) AS median_ratio, round(coalesce(min(r), 0), 6) AS min_ratio,
  round(coalesce(max(r), 0), 6) AS max_ratio, count(r) AS compared_leaves,
  count(*) - count(r) AS skipped_leaves
FROM (SELECT CASE WHEN nb >= 1e-12 THEN na / nb END AS r FROM norms)"""

META = """kinds AS (
  SELECT o_orderkey AS bundle, o_orderkey % 7 AS kind, o_custkey AS model, 1 + o_orderkey % 5 AS epochs,
         o_orderdate AS mtime FROM orders),
bodies AS (
  SELECT bundle, kind, '{' || concat_ws(',',
    CASE WHEN kind <> 4 THEN '"cumulative_epochs_completed":' ||
      CASE WHEN kind = 6 THEN 'null' ELSE epochs::VARCHAR END END,
    '"final_loss":' || model || '.5',
    CASE WHEN kind <> 1 THEN '"model_config":{"maxlen":128,"embed_dim":192}' END,
    CASE WHEN kind <> 2 THEN '"tokenizer_config":{"delimiter":"<|endoftext|>","name":"byte"}' END,
    '"created_at":"' || strftime(mtime, '%Y-%m-%d') || '"') || '}' AS body FROM kinds),
texts AS (
  SELECT bundle, CASE kind WHEN 3 THEN substr(body, 1, 40) WHEN 5 THEN '[' || body || ']' ELSE body END AS txt
  FROM bodies),
docs AS (SELECT bundle, CASE WHEN json_valid(txt) THEN txt END AS doc FROM texts),
parsed AS (
  SELECT bundle, CASE WHEN json_type(doc) = 'OBJECT'
                       AND (doc ->> '$.cumulative_epochs_completed') IS NOT NULL THEN doc END AS doc FROM docs)"""

EXAMPLES = f"""{CLEAN}, rows AS (SELECT {_bytes('text')} AS x FROM clean), pairs AS (
  SELECT unnest(x) AS ctx, unnest({_shifted()}) AS token FROM rows),
logits AS MATERIALIZED (
  SELECT ctx, token, count(*) AS n, ln(count(*) + 0.5::DOUBLE) AS logit FROM pairs GROUP BY ctx, token)"""

TURN_KEY = "coalesce(conv_id::VARCHAR, '') || '/' || coalesce(turn::VARCHAR, '')"

PROMPTS = f"""prompts AS (
  SELECT {TURN_KEY} AS prompt_id, {_bytes("coalesce(text, '')")} AS tokens FROM conversations
  WHERE role = 'user')"""


def _violations(source: str, columns: str, tests: list[tuple[str, str, str]]) -> str:
    """One branch per rule: (field, rule text, condition that must hold)."""
    branches = [
        f"SELECT config_id, {ix} AS rule_ix, '{field}' AS field, '{text}' AS rule FROM c WHERE NOT ({cond})"
        for ix, (field, text, cond) in enumerate(tests)
    ]
    return f"WITH c AS (SELECT {columns} FROM {source})\n" + "\nUNION ALL\n".join(branches)


def _above(field: str, bound: str = "0") -> tuple[str, str, str]:
    return field, f"{field} must be > {bound}", f"{field} > {bound}"


def _least(field: str, bound: str) -> tuple[str, str, str]:
    return field, f"{field} must be >= {bound}", f"{field} >= {bound}"


def _json_config(config: object, **replaced: str) -> str:
    """A configuration as a SQL expression giving its JSON text."""
    parts = []
    for name, value in vars(config).items():
        if name in replaced:
            text = f"' || {replaced[name]} || '"
        elif isinstance(value, bool):
            text = str(value).lower()
        elif isinstance(value, str):
            text = f'"{value}"'
        elif isinstance(value, float) and 0 < value < 1e-3:
            mantissa, exponent = f"{value:.1e}".split("e")
            text = f"{mantissa}E{int(exponent)}"
        else:
            text = repr(value)
        parts.append(f'"{name}":{text}')
    return "{" + ",".join(parts) + "}"


GRAMS = f"""{CLEAN}, toks AS (SELECT doc_id, {_bytes('text')} AS t FROM clean),
placed_grams AS (
  SELECT doc_id, unnest(t) AS c1, unnest(list_concat([-1], t[1:len(t) - 1])) AS c2,
    unnest(list_concat([-1, -1], t[1:len(t) - 2])) AS c3, unnest({_shifted('t')}) AS token FROM toks)"""

CONTEXTS = f"""{GRAMS},
grams AS (SELECT c1, c2, c3, token, count(*) AS n FROM placed_grams GROUP BY ALL),
ctxs AS MATERIALIZED (
  SELECT ctx, size, token, sum(n)::BIGINT AS n, ln(sum(n)::BIGINT + 0.5::DOUBLE) AS logit FROM (
    SELECT c1::VARCHAR AS ctx, 1 AS size, token, n FROM grams
    UNION ALL SELECT concat_ws(',', c2, c1), 2, token, n FROM grams WHERE c2 >= 0
    UNION ALL SELECT concat_ws(',', c3, c2, c1), 3, token, n FROM grams WHERE c3 >= 0)
  GROUP BY ctx, size, token)"""


def _generated(lookup: str, pick: str) -> str:
    """``lookup`` has a row per context, ``pick`` the token for row ``l`` at the state ``g``."""
    return f"""WITH RECURSIVE {CONTEXTS}, lookup AS MATERIALIZED ({lookup}), {PROMPTS.replace('prompts AS', 'every AS')},
prompts AS (SELECT * FROM every WHERE len(tokens) > 0),
gen(prompt_id, step, tok, tail) AS (
  SELECT prompt_id, 0, tokens[-1], tokens[greatest(len(tokens) - 2, 1):] FROM prompts
  UNION ALL
  SELECT prompt_id, step + 1, tok, list_append(tail, tok)[greatest(len(tail) - 1, 1):] FROM (
    SELECT prompt_id, step, tail, arg_max(tok, size) AS tok FROM (
      SELECT g.prompt_id, g.step, g.tail, l.size, {pick} AS tok
      FROM (SELECT prompt_id, step, tail, unnest(range(1, len(tail) + 1)) AS k FROM gen WHERE step < 12) g
      JOIN lookup l ON l.ctx = array_to_string(g.tail[len(g.tail) - k + 1:], ','))
    GROUP BY prompt_id, step, tail)
  WHERE tok <> 256)
SELECT p.prompt_id, len(any_value(p.tokens)) + count(g.step) AS n_tokens, count(g.step) AS n_new,
  coalesce(string_agg(g.tok, ',' ORDER BY g.step), '') AS new_tokens
FROM prompts p LEFT JOIN (SELECT * FROM gen WHERE step > 0) g ON g.prompt_id = p.prompt_id
GROUP BY p.prompt_id"""


def _running(ctx: str, source: str) -> str:
    """Tokens of each context with the running sums of their weights at temperature 0.8."""
    return f"""SELECT {ctx}, list(token ORDER BY token) AS tokens, list(cum ORDER BY token) AS cums FROM (
  SELECT *, sum(w) OVER (PARTITION BY ctx ORDER BY token ROWS UNBOUNDED PRECEDING) AS cum FROM (
    SELECT *, exp((logit - max(logit) OVER (PARTITION BY ctx)) / 0.8::DOUBLE) AS w FROM {source})) GROUP BY {ctx}"""


def _drawn(u: str) -> str:
    return f"l.tokens[len(list_filter(l.cums, lambda c: c < {u} * l.cums[-1])) + 1]"


def oracle_queries() -> dict[str, str]:
    digest = "md5(text) AS text_md5, length(text) AS n_chars"
    batched = "(ix % 32)::INT AS slot, ix // 32 AS batch_id"
    fixed_batches = f"""{_windows(32)}, numbered AS (
  SELECT x, row_number() OVER (ORDER BY doc_id, "window") - 1 AS ix, count(*) OVER () AS n FROM rows),
packed AS (SELECT ix // 8 AS batch_id, ix % 8 AS slot, x FROM numbered WHERE ix // 8 < n // 8)"""
    names = ", ".join(f"'{n}'" for n in TOKENIZER_NAMES)
    defaults = vars(TrainingConfig())
    named = {
        "scan_blocks": f"WITH {PADDED} SELECT {digest} FROM padded",
        "scan_malformed": f"""WITH odd AS (
  SELECT {_trim("text || chr(10) || 'x' || chr(10) || 'y' || chr(65533) || '(' || chr(65533)")} || '{END}' AS text
  FROM documents WHERE text <> '') SELECT {digest} FROM odd""",
        "first_blocks": f"WITH {CLEAN} SELECT doc_id, {digest} FROM clean ORDER BY doc_id LIMIT 100",
        "corpus_profile": f"""WITH {CLEAN} SELECT count(*) + 1 AS n_pieces, min(length(text)) AS min_chars,
  max(length(text)) AS max_chars, round(sum(length(text)) / count(*)::DOUBLE, 6) AS avg_chars,
  arg_min(substr(text, 1, 300), doc_id) AS opening FROM clean""",
        "bundle_catalog": """SELECT DISTINCT 'run_' || label AS bundle, 2::BIGINT AS previous_epochs, 'ok' AS status
FROM embeddings WHERE label <> 9""",
        "write_bundle": """SELECT 'run_' || label AS bundle, count(*) AS n_leaves,
  sum(len(embedding))::BIGINT AS n_values FROM embeddings GROUP BY label""",
        "load_weights": """SELECT 'leaf_' || vec_id AS leaf, len(embedding)::BIGINT AS n_values,
  round(sqrt(list_sum(list_transform(embedding,
    lambda v: ((v::DOUBLE * (1.0::DOUBLE + label * 0.01::DOUBLE))::FLOAT)::DOUBLE ** 2))), 6) AS norm
FROM embeddings""",
        # Stored values are single precision.
        "compare_bundles": f"""WITH {WEIGHTS}, m AS (
  SELECT median(na / nb) AS r FROM (
    SELECT sqrt(sum(b * b)) AS nb, sqrt(sum(a::FLOAT::DOUBLE * a::FLOAT::DOUBLE)) AS na FROM pair GROUP BY leaf)
  WHERE nb >= 1e-12),
p AS (SELECT r, abs(r - 1.0) * 100 AS pct FROM m),
s AS (
  SELECT count(*) AS total_params, count(*) FILTER (d > 1e-8) AS changed_params, median(d) AS med, avg(d) AS mean
  FROM (SELECT abs(b - a::FLOAT::DOUBLE) AS d FROM pair))
SELECT 'run_before' AS before, 'run_after' AS after, total_params, changed_params,
  total_params - changed_params AS unchanged_params, round(med, 9) AS median_change, round(mean, 9) AS mean_change,
  CASE WHEN changed_params / total_params::DOUBLE * 100.0 < 1
      THEN printf('nearly identical: %.2f%% changed', changed_params / total_params::DOUBLE * 100.0)
    WHEN changed_params / total_params::DOUBLE * 100.0 < 50
      THEN printf('minority changed: %.1f%%', changed_params / total_params::DOUBLE * 100.0)
    WHEN med < 1e-4 THEN printf('subtly different: %.1f%% changed, median %.1e', changed_params / total_params::DOUBLE * 100.0, med)
    ELSE printf('substantially different: %.1f%% changed, median %.6f', changed_params / total_params::DOUBLE * 100.0, med)
  END AS state_verdict,
  CASE WHEN pct < 1 THEN printf('very similar: %.2f%%', pct)
  WHEN pct < 5 THEN printf('moderately different: %.1f%%', pct)
  WHEN r > 1 THEN printf('grown by %.1f%%', pct) ELSE printf('shrunk by %.1f%%', pct) END AS norm_verdict FROM p, s""",
        "run_metadata": f"""WITH {META} SELECT bundle, (doc IS NOT NULL)::INT AS readable,
  coalesce((doc ->> '$.cumulative_epochs_completed')::BIGINT, -1) AS epochs,
  coalesce((doc ->> '$.final_loss')::DOUBLE, -1) AS final_loss,
  coalesce((doc ->> '$.model_config.maxlen')::BIGINT, -1) AS maxlen,
  coalesce(doc ->> '$.created_at', '') AS created_at FROM parsed""",
        "restore_status": f"""WITH {META} SELECT bundle, CASE WHEN doc IS NULL THEN 'no_metadata'
  WHEN (doc -> '$.model_config') IS NULL THEN 'no_model_config'
  WHEN (doc -> '$.tokenizer_config') IS NULL THEN 'no_tokenizer_config' ELSE 'ok' END AS status
FROM parsed""",
        "normalize_blocks": f"WITH {PADDED} SELECT doc_id, {digest} FROM padded",
        "tokenize_bytes": f"""WITH {CLEAN}, toks AS (
  SELECT doc_id, {_bytes("text || chr(10) || text")} AS t FROM clean)
SELECT doc_id, len(t) AS n_tokens, {_csv('t')} AS tokens FROM toks""",
        "build_vocab": f"WITH {WORDS} SELECT token_id::INT AS token_id, token, n FROM vocab",
        "tokenize_words": f"""WITH {WORDS} SELECT doc_id, count(*) AS n_tokens,
  string_agg(token_id, ',' ORDER BY pos) AS tokens FROM placed JOIN vocab USING (token) GROUP BY doc_id""",
        "truncate_pad": f"""WITH {CLEAN}
SELECT doc_id, {_csv(f"list_resize({_bytes('text')}, 96, 7)")} AS tokens FROM clean""",
        "detokenize": f"WITH {CLEAN} SELECT doc_id, {digest} FROM clean",
        "shuffle_order": """SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS visit_ix
FROM documents""",
        "batch_rows": f"WITH {ORDERED} SELECT doc_id, {batched} FROM ordered WHERE ix // 32 < n // 32",
        "batch_rows_keep": f"WITH {ORDERED} SELECT doc_id, {batched} FROM ordered",
        "pack_batches": f"""WITH {fixed_batches} SELECT batch_id, count(*) AS n_rows,
  string_agg({_csv('x')}, ';' ORDER BY slot) AS rows FROM packed GROUP BY batch_id""",
        "position_major": f"""WITH {fixed_batches}, cells AS (
  SELECT batch_id, slot, generate_subscripts(x, 1) - 1 AS position, unnest(x) AS token FROM packed)
SELECT batch_id, position, string_agg(token, ',' ORDER BY slot) AS tokens FROM cells
GROUP BY batch_id, position""",
        "shift_targets": f"""WITH {CLEAN}, tokens AS (SELECT doc_id, {_bytes('text')} AS t FROM clean)
SELECT doc_id, w::INT AS "window", {_csv('list_resize(t[w * 128 + 2:w * 128 + 129], 128, 0)')} AS y
FROM (SELECT doc_id, t, unnest(range(0, (len(t) + 127) // 128)) AS w FROM tokens)""",
        "batches_per_epoch": """WITH c AS (
  SELECT lang, source, count(*) AS n_records, CASE WHEN lang = 'en' THEN 32 ELSE 64 END::BIGINT AS batch_size
  FROM documents GROUP BY lang, source)
SELECT lang, source, n_records, batch_size, n_records // batch_size AS n_batches,
  CASE WHEN n_records // batch_size = 0 THEN 'no_full_batch' ELSE 'ok' END AS status FROM c""",
        "training_examples": f"""WITH {_rows(128)}, numbered AS (
  SELECT doc_id, x, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS ix,
         count(*) OVER () AS n FROM rows)
SELECT ix // 32 AS batch_id, (ix % 32)::INT AS slot, doc_id, {_csv('x')} AS x, {_csv(_shifted())} AS y
FROM numbered WHERE ix // 32 < n // 32""",
        "training_examples_from_files": f"""WITH {_rows(128)}, blocks AS (
  SELECT row_number() OVER (ORDER BY doc_id) - 1 AS block_ix, x FROM rows),
numbered AS (
  SELECT block_ix, x, row_number() OVER (ORDER BY md5('42:' || block_ix), block_ix) - 1 AS ix,
         count(*) OVER () AS n FROM blocks)
SELECT ix // 32 AS batch_id, (ix % 32)::INT AS slot, block_ix, {_csv('x')} AS x, {_csv(_shifted())} AS y
FROM numbered WHERE ix // 32 < n // 32""",
        "plan_training_run": f"""WITH {CLEAN}, n AS (SELECT count(*) AS n FROM clean),
s AS (SELECT n, n // {defaults['batch_size']} AS b, n // {defaults['batch_size']} * {defaults['epochs']} AS total FROM n)
SELECT 'run_1' AS run_id, n AS n_records, b AS n_batches, total AS total_steps,
  greatest(1, floor(total * {defaults['warmup_rate']})::BIGINT) AS warmup_steps,
  2 + {defaults['epochs']}::BIGINT AS cumulative_epochs, 'ok' AS status FROM s""",
        "epoch_expand": f"""WITH {ORDERED} SELECT doc_id, {batched}, epoch::INT AS epoch
FROM ordered, range(1, 4) e(epoch) WHERE ix // 32 < n // 32""",
        "run_step_plan": f"""WITH {CUSTOMER_PLAN}
SELECT run_id, total_steps, warmup_steps, status FROM status""",
        "lr_schedule": f"""WITH {CUSTOMER_PLAN}, expanded AS (
  SELECT *, unnest(range(total_steps)) AS step FROM status WHERE status = 'ok')
SELECT run_id, step, round({LR.format(step='step')}, 9) AS learning_rate FROM expanded""",
        "loss_windows": f"""WITH {STEPS} SELECT run_id, g, end_epoch, end_step, n_losses,
  round(window_mean, 6) AS window_mean FROM windows""",
        "epoch_mean_loss": f"""WITH {STEPS} SELECT run_id, end_epoch AS epoch, count(*) AS n_windows,
  round(avg(window_mean), 6) AS mean_loss FROM windows GROUP BY run_id, end_epoch""",
        "final_loss": f"""WITH {STEPS}, last AS (
  SELECT run_id, arg_max(window_mean, g) AS l FROM windows GROUP BY run_id)
SELECT r.run_id, coalesce(round(l, 6), -1) AS final_loss
FROM (SELECT DISTINCT run_id FROM steps) r LEFT JOIN last USING (run_id)""",
        "metric_schema_check": """SELECT event_type AS name, count(*) AS n,
  CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'declared' ELSE 'unknown_metric' END AS status
FROM events GROUP BY event_type""",
        "logged_lr": f"""WITH {STEPS}, rated AS (
  SELECT *, 100 AS total_steps, 10 AS warmup_steps, 0.001::DOUBLE * (run_id % 7) AS lr_peak,
    CASE WHEN run_id % 7 = 0 THEN 0.0::DOUBLE ELSE 0.00001::DOUBLE END AS floor_rate FROM windows)
SELECT run_id, g, end_epoch, end_step, round(window_mean, 6) AS window_mean,
  round({LR.format(step='end_step')}, 9) AS learning_rate, 'ok' AS status FROM rated""",
        "loss_history": f"""WITH {STEPS}
SELECT run_id // 4 AS lineage, row_number() OVER (PARTITION BY run_id // 4 ORDER BY run_id % 4, g) - 1 AS ix,
  (run_id % 4)::INT AS phase, g, round(window_mean, 6) AS window_mean FROM windows""",
        "structure_diff": """WITH b AS (SELECT 'leaf_' || vec_id AS leaf, len(embedding) AS n FROM embeddings),
a AS (SELECT CASE WHEN label = 3 THEN 'renamed_' ELSE '' END || 'leaf_' || vec_id AS leaf,
       len(embedding) - CASE WHEN label = 4 THEN 1 ELSE 0 END AS n FROM embeddings)
SELECT coalesce(b.leaf, a.leaf) AS leaf, coalesce(b.n, -1) AS n_before, coalesce(a.n, -1) AS n_after,
  CASE WHEN b.n IS NULL THEN 'only_after' WHEN a.n IS NULL THEN 'only_before' ELSE 'size_differs' END AS problem
FROM b FULL JOIN a ON a.leaf = b.leaf WHERE b.n IS DISTINCT FROM a.n""",
        "leaf_norms": f"WITH {WEIGHTS} SELECT leaf, n_values, round(na, 6) AS norm FROM norms",
        "compare_norms": f"WITH {WEIGHTS} {RATIO_SUMMARY}",
        "compare_norms_finite": f"WITH {WEIGHTS} {RATIO_SUMMARY.replace('nb >= 1e-12', 'nb > 0')}",
        "norm_verdict": f"""WITH {WEIGHTS}, m AS (
  SELECT median(na / nb) AS r FROM norms WHERE nb >= 1e-12),
p AS (SELECT r, abs(r - 1.0) * 100 AS pct FROM m)
SELECT CASE WHEN pct < 1 THEN printf('very similar: %.2f%%', pct)
  WHEN pct < 5 THEN printf('moderately different: %.1f%%', pct)
  WHEN r > 1 THEN printf('grown by %.1f%%', pct) ELSE printf('shrunk by %.1f%%', pct) END AS verdict FROM p""",
        "compare_states": f"""WITH {WEIGHTS} SELECT count(*) AS total_params,
  count(*) FILTER (WHERE d > 1e-8) AS changed_params,
  round(count(*) FILTER (WHERE d > 1e-8) / count(*)::DOUBLE * 100.0, 6) AS percent_changed,
  round(median(d), 9) AS median_change, round(avg(d), 9) AS mean_change, round(max(d), 9) AS max_change,
  round(min(d), 9) AS min_change, 1e-8::DOUBLE AS change_threshold FROM diffs""",
        "state_verdict": f"""WITH {WEIGHTS}, s AS (SELECT count(*) FILTER (WHERE d <= 1e-8) AS unchanged_params,
  count(*) FILTER (WHERE d > 1e-8) / count(*)::DOUBLE * 100.0 AS pct, median(d) AS m FROM diffs)
SELECT unchanged_params, CASE WHEN pct < 1 THEN printf('nearly identical: %.2f%% changed', pct)
  WHEN pct < 50 THEN printf('minority changed: %.1f%%', pct)
  WHEN m < 1e-4 THEN printf('subtly different: %.1f%% changed, median %.2e', pct, m)
  ELSE printf('substantially different: %.1f%% changed, median %.6f', pct, m) END AS verdict FROM s""",
        "count_params": "SELECT sum(len(embedding))::BIGINT AS n_params FROM embeddings WHERE label <> 9",
        "roundtrip_integrity": """SELECT sum(len(embedding))::BIGINT AS total_params, 0::BIGINT AS changed_params,
  0.0::DOUBLE AS max_change FROM embeddings""",
        "leaf_change_stats": f"""WITH {WEIGHTS} SELECT leaf, count(*) AS total_params,
  count(*) FILTER (WHERE d > 1e-8) AS changed_params,
  round(count(*) FILTER (WHERE d > 1e-8) / count(*)::DOUBLE * 100.0, 6) AS percent_changed,
  round(avg(d), 9) AS mean_change, round(max(d), 9) AS max_change, round(min(d), 9) AS min_change
FROM diffs GROUP BY leaf""",
        "latest_bundle": """SELECT o_orderkey AS bundle, o_custkey AS model,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS mtime
FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 1""",
        "latest_bundles": """SELECT o_custkey AS model, recency::INT AS recency, o_orderkey AS bundle,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS mtime
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS recency
      FROM orders) WHERE recency <= 2""",
        "checkpoint_pairs": """WITH r AS (
  SELECT o_custkey AS model, o_orderkey AS after,
    lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey DESC) AS before,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders)
SELECT model, coalesce(before, -1) AS before, after,
  CASE WHEN before IS NULL THEN 'too_few' ELSE 'ok' END AS status FROM r WHERE rn = 1""",
        "cumulative_epochs": """WITH c AS (SELECT o_custkey AS model, o_orderkey AS bundle,
  1 + o_orderkey % 5 AS epochs, o_orderdate FROM orders),
s AS (SELECT *, sum(epochs) OVER (PARTITION BY model ORDER BY o_orderdate, bundle
  ROWS UNBOUNDED PRECEDING)::BIGINT AS cumulative_epochs FROM c)
SELECT model, bundle, epochs, cumulative_epochs - epochs AS previous_epochs, cumulative_epochs FROM s""",
        "resume_lineage": """WITH RECURSIVE o AS (
  SELECT o_orderkey AS run_id, o_custkey AS model, 1 + o_orderkey % 5 AS epochs, lag(o_orderkey) OVER w AS before,
    lag(o_orderkey, 2) OVER w AS earlier, last_value(o_orderkey) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS newest
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
l AS (
  SELECT run_id, epochs, CASE WHEN before IS NULL AND model % 10 = 0 THEN newest
    WHEN before IS NULL AND model % 11 = 0 THEN -1
    WHEN run_id % 3 = 0 AND earlier IS NOT NULL THEN earlier ELSE before END AS parent FROM o),
up AS (
  SELECT run_id, run_id AS root, 0::BIGINT AS depth, epochs::BIGINT AS total FROM l
  WHERE parent IS NULL OR parent NOT IN (SELECT run_id FROM l)
  UNION ALL
  SELECT l.run_id, up.root, up.depth + 1, up.total + l.epochs FROM up JOIN l ON l.parent = up.run_id)
SELECT l.run_id, coalesce(root, -1) AS root, coalesce(depth, -1) AS depth,
  coalesce((total - epochs)::BIGINT, -1) AS previous_epochs, coalesce(total::BIGINT, -1) AS cumulative_epochs,
  CASE WHEN root IS NULL THEN 'cycle' WHEN parent = -1 THEN 'unknown_parent' ELSE '' END AS problem
FROM l LEFT JOIN up ON up.run_id = l.run_id""",
        "resume_context": f"""WITH {META} SELECT bundle,
  coalesce((doc ->> '$.cumulative_epochs_completed')::BIGINT, -1) AS previous_epochs,
  CASE WHEN doc IS NULL THEN 'no_readable_metadata' ELSE 'ok' END AS status FROM parsed""",
        "assemble_metadata": f"""WITH {STEPS}, last AS (
  SELECT run_id, round(arg_max(window_mean, g), 6) AS l FROM windows GROUP BY run_id),
runs AS (SELECT DISTINCT run_id, run_id % 5 + 1 AS epochs FROM steps),
summed AS (SELECT *, sum(epochs) OVER (PARTITION BY run_id // 4 ORDER BY run_id % 4
  ROWS UNBOUNDED PRECEDING)::BIGINT AS total FROM runs)
SELECT 'run_' || run_id AS bundle, '{{"cumulative_epochs_completed":' || total || ',"final_loss":' ||
  coalesce(l::VARCHAR, 'null') || ',"model_config":{_json_config(ModelConfig())},"training_config":' ||
  '{_json_config(TrainingConfig(), epochs='epochs')}' ||
  ',"tokenizer_config":{{"delimiter":"{END}","name":"byte","pad_token_id":0}},"created_at":"2024-01-01T00:00:00"}}'
  AS json
FROM summed LEFT JOIN last USING (run_id)""",
        "run_names": """SELECT event_id, event_type || '_' || strftime(ts, '%Y%m%d_%H%M%S') AS run_name
FROM events""",
        "apply_overrides": f"""SELECT c_custkey AS run_id,
  CASE WHEN c_nationkey % 3 <> 0 THEN c_nationkey * 8 ELSE {defaults['batch_size']} END::INT AS batch_size,
  CASE WHEN c_custkey % 4 = 1 THEN c_nationkey ELSE {defaults['epochs']} END::INT AS epochs,
  CASE WHEN c_custkey % 5 = 2 THEN c_nationkey * 10 ELSE {defaults['max_stories']} END::INT AS max_stories,
  CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE {defaults['seed']} END::INT AS seed,
  CASE WHEN c_custkey % 3 = 0 THEN (c_custkey % 2 = 0)::INT ELSE {int(defaults['shuffle'])} END::INT AS shuffle
FROM customer""",
        "model_config_violations": _violations(
            "part",
            "p_partkey AS config_id, p_size - 3 AS maxlen, p_partkey % 9 AS vocab_size, "
            "p_size * 3 - 9 AS embed_dim, p_partkey % 5 AS num_heads, p_size - 1 AS feed_forward_dim, "
            "p_partkey % 6 AS num_transformer_blocks",
            [
                *map(
                    _above,
                    ["maxlen", "vocab_size", "embed_dim", "num_heads", "feed_forward_dim", "num_transformer_blocks"],
                ),
                (
                    "embed_dim",
                    "embed_dim must be a multiple of num_heads",
                    "coalesce(embed_dim % nullif(num_heads, 0) = 0, TRUE)",
                ),
            ],
        ),
        "training_config_violations": _violations(
            "customer",
            "c_custkey AS config_id, c_nationkey AS batch_size, c_custkey % 4 AS epochs, "
            "c_nationkey - 1 AS max_stories, c_nationkey - 2 AS num_workers, "
            "c_acctbal / 5000.0::DOUBLE AS warmup_rate, c_acctbal / 1000.0::DOUBLE AS lr_init_value, "
            "2.0::DOUBLE AS lr_peak_value, c_acctbal + 500.0::DOUBLE AS lr_end_value, "
            "c_acctbal + 100.0::DOUBLE AS weight_decay, c_custkey % 3 AS log_every_n_steps",
            [
                _above("batch_size"),
                _above("epochs"),
                _above("max_stories"),
                _least("num_workers", "0"),
                ("warmup_rate", "warmup_rate must be in [0.0, 1.0]", "warmup_rate BETWEEN 0 AND 1"),
                _least("lr_init_value", "0.0"),
                (
                    "lr_init_value",
                    "lr_init_value must be <= lr_peak_value",
                    "lr_init_value <= lr_peak_value",
                ),
                _least("lr_end_value", "0.0"),
                _least("weight_decay", "0.0"),
                _above("log_every_n_steps"),
            ],
        ),
        "inference_config_violations": _violations(
            "customer",
            "c_custkey AS config_id, c_nationkey - 4 AS max_new_tokens, c_acctbal AS temperature",
            [_above("max_new_tokens"), _above("temperature", "0.0")],
        ),
        "tokenizer_config_violations": _violations(
            "part",
            "p_partkey AS config_id, CASE WHEN p_size % 5 = 0 THEN '' ELSE p_brand END AS delimiter, "
            "CASE WHEN p_size % 2 = 0 THEN 'byte' ELSE lower(p_type) END AS name, p_size - 4 AS pad_token_id",
            [
                ("delimiter", "delimiter must not be empty", "delimiter <> ''"),
                _least("pad_token_id", "0"),
                ("name", "name must be a registered name", f"name IN ({names})"),
            ],
        ),
        "embed_lookup": f"""WITH {_windows(32)}, placed AS (
  SELECT doc_id, "window", unnest(x) AS token, generate_subscripts(x, 1) - 1 AS pos FROM rows),
added AS (
  SELECT t.vec_id AS token, p.vec_id - 257 AS pos, list_transform(list_zip(t.embedding, p.embedding),
    lambda z: z[1]::DOUBLE + z[2]::DOUBLE) AS v
  FROM embeddings t JOIN embeddings p ON t.vec_id < 257 AND p.vec_id BETWEEN 257 AND 288)
SELECT doc_id, "window", pos, token, round(v[1], 6) AS first, round(v[-1], 6) AS last, round(list_sum(v), 6) AS total
FROM placed JOIN added USING (token, pos)""",
        "causal_prefix": f"""WITH {_windows(64)}, placed AS (
  SELECT doc_id, "window", unnest(x) AS token, generate_subscripts(x, 1) - 1 AS pos FROM rows),
seen AS (
  SELECT doc_id, "window", pos, sum(token) OVER (PARTITION BY doc_id, "window" ORDER BY pos)::BIGINT AS s FROM placed)
SELECT doc_id, "window", count(*) AS n_positions, string_agg(pos + 1, ',' ORDER BY pos) AS n_visible,
  string_agg(s, ',' ORDER BY pos) AS visible_sums FROM seen GROUP BY "window", doc_id""",
        "next_token_table": f"WITH {CONTEXTS} SELECT ctx, token, n, round(logit, 6) AS logit FROM ctxs",
        "held_out_loss": f"""WITH {GRAMS},
g AS (SELECT coalesce(doc_id % 3 = 1, false) AS held, c2, c1, token, count(*) AS n FROM placed_grams GROUP BY ALL),
e2 AS (SELECT c2, c1, token, n FROM g WHERE NOT held),
t2 AS (SELECT c2, c1, sum(n) AS total, count(*) AS types FROM e2 GROUP BY ALL),
e1 AS (SELECT c1, token, count(*) AS n FROM e2 GROUP BY ALL),
t1 AS (SELECT c1, sum(n) AS total, count(*) AS types FROM e1 GROUP BY ALL),
e0 AS (SELECT token, count(*) AS n FROM e1 GROUP BY ALL),
t0 AS (SELECT sum(n) AS total, count(*) AS types FROM e0),
p0 AS (
  SELECT g.c2, g.c1, g.token, g.n AS held,
    (greatest(coalesce(e0.n, 0) - 0.75::DOUBLE, 0) + 0.75::DOUBLE * t0.types / 257.0::DOUBLE) / t0.total AS p
  FROM g LEFT JOIN e0 USING (token), t0 WHERE g.held),
p1 AS (
  SELECT p0.*, CASE WHEN t1.total IS NULL THEN p ELSE
    (greatest(coalesce(e1.n, 0) - 0.75::DOUBLE, 0) + 0.75::DOUBLE * t1.types * p) / t1.total END AS q
  FROM p0 LEFT JOIN e1 USING (c1, token) LEFT JOIN t1 USING (c1)),
p2 AS (
  SELECT p1.held, CASE WHEN t2.total IS NULL THEN q ELSE
    (greatest(coalesce(e2.n, 0) - 0.75::DOUBLE, 0) + 0.75::DOUBLE * t2.types * q) / t2.total END AS r
  FROM p1 LEFT JOIN e2 USING (c2, c1, token) LEFT JOIN t2 USING (c2, c1))
SELECT coalesce(sum(held), 0)::BIGINT AS n_positions, round(sum(-ln(r) * held) / sum(held), 6) AS loss FROM p2""",
        "cross_entropy": f"""WITH {EXAMPLES}, norm AS (SELECT ctx, ln(sum(exp(logit))) AS z FROM logits GROUP BY ctx)
SELECT sum(n)::BIGINT AS n_positions, round(sum(n * (z - logit)) / sum(n), 6) AS loss
FROM logits JOIN norm USING (ctx)""",
        "temperature_softmax": f"""WITH {EXAMPLES}
SELECT ctx, token, round(exp(logit / 0.8::DOUBLE) / sum(exp(logit / 0.8::DOUBLE)) OVER (PARTITION BY ctx), 6) AS p
FROM logits""",
        "greedy_next": f"""WITH {EXAMPLES} SELECT ctx, token FROM (
  SELECT *, row_number() OVER (PARTITION BY ctx ORDER BY n DESC, token) AS rn FROM logits) WHERE rn = 1""",
        "sample_next": f"""WITH {EXAMPLES}, l AS ({_running('ctx', 'logits')})
SELECT ctx, {_drawn(_uniform('7', 'ctx'))} AS token FROM l""",
        "generate_batch": _generated(_running("ctx, size", "ctxs"), _drawn(_uniform("7", "g.prompt_id", "g.step"))),
        "generate_greedy": _generated(
            "SELECT ctx, size, arg_max(token, n * 1000 - token) AS token FROM ctxs GROUP BY ctx, size", "l.token"
        ),
        "prompt_problems": f"""SELECT {TURN_KEY} AS prompt_id, 'empty_prompt' AS problem FROM conversations
WHERE role = 'user' AND (coalesce(conv_id % 5 = 0, false) OR coalesce(text, '') = '')""",
        "detokenize_words": f"""WITH {WORDS} SELECT doc_id, md5(string_agg(token, ' ' ORDER BY pos)) AS text_md5
FROM placed GROUP BY doc_id""",
        "continue_prompts": f"""WITH RECURSIVE {WORDS},
follows AS MATERIALIZED (
  SELECT ctx, arg_max(id, n * 100000000 - id) AS tok FROM (
    SELECT v.token_id AS ctx, coalesce(u.token_id, 0) AS id, count(*) AS n FROM (
      SELECT token, lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM placed) p
    JOIN vocab v ON v.token = p.token LEFT JOIN vocab u ON u.token = p.nxt GROUP BY 1, 2) c
  GROUP BY ctx),
asked AS (
  SELECT {TURN_KEY} AS prompt_id, regexp_extract_all(text, '[^ \t\n\r\f\x0b]+') AS w
  FROM conversations WHERE trim(text) <> ''),
coded AS (
  SELECT prompt_id, pos, coalesce(token_id, 0) AS id, token FROM (
    SELECT prompt_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM asked) a
  LEFT JOIN vocab ON vocab.token = a.word),
gen(prompt_id, step, tok) AS (
  SELECT prompt_id, 0, arg_max(id, pos) FROM coded GROUP BY prompt_id
  UNION ALL
  SELECT g.prompt_id, g.step + 1, f.tok FROM gen g JOIN follows f ON f.ctx = g.tok
  WHERE g.step < 4 AND f.tok <> (SELECT token_id FROM vocab WHERE token = '{END}')),
said AS (
  SELECT prompt_id, pos, token FROM coded
  UNION ALL
  SELECT prompt_id, 1000000000 + step, token FROM gen LEFT JOIN vocab ON token_id = tok WHERE step > 0)
SELECT prompt_id, coalesce(string_agg(token, ' ' ORDER BY pos), '') AS text FROM said GROUP BY prompt_id""",
        "context_window": f"""WITH {PROMPTS} SELECT prompt_id, least(len(tokens), 64) AS n_real,
  {_csv("list_resize(tokens[-least(len(tokens), 64):], 64, 0)")} AS tokens FROM prompts""",
    }
    # How leaves are cut into chunks changes no result.
    for name in ("compare_states", "leaf_change_stats"):
        named[f"{name}_other_chunks"] = named[name]
    return named
