"""DuckDB SQL twins of the catalogue, written plainly: whole-table windows and full unpacking."""

from __future__ import annotations

from corpusforge.functions.text import PRETOKEN_PATTERN, STRIP_CLASS
from corpusforge.plans.catalogue import (
    B, BATCH_TOKENS, MERGES, RANKS, RESUME_STEP, SEED, SFT_EPOCHS, SFT_WEIGHT, SHARD, T, TOP_K, USER_CONTEXT,
)

BT = B * T
GRAD_ACCUM = BATCH_TOKENS // (BT * RANKS)


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^{STRIP_CLASS}|{STRIP_CLASS}$', '', 'g')"


def byte_ids(e: str) -> str:
    return f"list_transform(regexp_extract_all(hex(encode({e})), '..'), lambda h: CAST('0x' || h AS INTEGER))"


# Named building blocks: (name, body). A query lists the ones it needs, in this order.
PARTS: dict[str, str] = {
    "o": """
        SELECT doc_id, text, strlen(text) + 1 AS n,
               CAST(sum(strlen(text) + 1) OVER (ORDER BY doc_id) - (strlen(text) + 1) AS BIGINT) AS start
        FROM documents""",
    "shards": f"""
        SELECT s AS shard_idx, least({SHARD}, total - s * {SHARD}) AS n,
               CASE WHEN s = 0 AND total >= {SHARD} THEN 'val' ELSE 'train' END AS split
        FROM (SELECT total, unnest(range((total + {SHARD - 1}) // {SHARD})) AS s
              FROM (SELECT CAST(sum(n) AS BIGINT) AS total FROM o))""",
    "pieces": f"""
        SELECT doc_id, s AS shard_idx, greatest(start, s * {SHARD}) - s * {SHARD} AS lo,
               least(start + n, (s + 1) * {SHARD}) - s * {SHARD} AS hi
        FROM (SELECT doc_id, start, n,
                     unnest(range(start // {SHARD}, (start + n - 1) // {SHARD} + 1)) AS s FROM o)""",
    "tok": f"""
        SELECT start + i AS p, id
        FROM (SELECT start, unnest(ids) AS id, generate_subscripts(ids, 1) - 1 AS i
              FROM (SELECT start, list_concat([256], {byte_ids('text')}) AS ids FROM o))""",
    "wt": f"""
        SELECT x.*, sh.split
        FROM (SELECT p // {SHARD} AS shard_idx, p % {SHARD} AS q, (p % {SHARD} - 1) // {T} AS w, id AS y,
                     lag(id) OVER s AS h1,
                     CASE WHEN (p % {SHARD} - 1) % {T} >= 1 THEN lag(id, 2) OVER s END AS h2
              FROM tok WINDOW s AS (PARTITION BY p // {SHARD} ORDER BY p)) x
        JOIN shards sh USING (shard_idx)
        WHERE q >= 1 AND w < ((n - 1) // {BT}) * {B}""",
    "lp": f"""
        SELECT split, r AS rank, shard_idx, n,
               CASE WHEN {BT} * (r + 1) + 1 <= n
                    THEN 1 + len(list_filter(range(1, n // {BT} + 2),
                                             lambda k: {BT} * (r + k * {RANKS}) + {BT * RANKS} + 1 <= n))
                    ELSE 0 END AS n_batches
        FROM (SELECT *, unnest(range({RANKS})) AS r FROM shards)""",
    "sched": f"""
        SELECT split, rank, epoch, shard_idx, {BT} * (rank + i * {RANKS}) AS pos,
               row_number() OVER (PARTITION BY split, rank ORDER BY epoch, shard_idx, i) - 1 AS micro_step
        FROM (SELECT *, unnest(range(n_batches)) AS i
              FROM (SELECT *, unnest(range(2)) AS epoch FROM lp))""",
    "turns": """
        SELECT a.conv_id, a.turn, u.text AS question, coalesce(s.text, '') AS support, a.text AS reply
        FROM conversations a
        JOIN conversations u ON u.conv_id = a.conv_id AND u.turn = a.turn - 1 AND u.role = 'user'
        LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS text FROM conversations
                   WHERE role = 'system' GROUP BY conv_id) s ON s.conv_id = a.conv_id
        WHERE a.role = 'assistant'""",
    "sq0": f"""
        SELECT conv_id, row_number() OVER (ORDER BY conv_id, turn, i) - 1 AS item_id, question, support, answer
        FROM (SELECT conv_id, turn, question, support, unnest(ss) AS answer,
                     generate_subscripts(ss, 1) - 1 AS i
              FROM (SELECT *, list_filter(list_transform(regexp_split_to_array(reply, '[.!?\\n]+'),
                                                         lambda x: {strip('x')}), lambda x: x <> '') AS ss
                    FROM turns))""",
    "sciq": f"""
        SELECT 'sciq' AS source,
               CASE WHEN conv_id % 10 < 8 THEN 'train' WHEN conv_id % 10 = 8 THEN 'validation'
                    ELSE 'test' END AS split,
               item_id,
               CASE WHEN {strip('support')} <> '' THEN {strip('support')} || ' ' || {strip('question')}
                    ELSE {strip('question')} END AS context,
               answer,
               [{strip('answer')}, {strip('d1')}, {strip('d2')}, {strip('d3')}] AS choices,
               CAST(0 AS BIGINT) AS gold_idx
        FROM (SELECT *, lead(answer, 1) OVER s AS d1, lead(answer, 2) OVER s AS d2,
                     lead(answer, 3) OVER s AS d3
              FROM sq0 WINDOW s AS (ORDER BY item_id))
        WHERE d3 IS NOT NULL""",
    "arc0": r"""
        SELECT item_id, question, tail, n, CAST(item_id % n AS BIGINT) AS gold,
               list_filter([lead(tail, 1) OVER s, lead(tail, 2) OVER s, lead(tail, 3) OVER s],
                           lambda x: x IS NOT NULL) AS nxt,
               (CASE WHEN item_id % 3 = 0 THEN ['1', '2', '3', '4'] ELSE ['A', 'B', 'C', 'D'] END)[1:n] AS labels
        FROM (SELECT item_id, CASE WHEN item_id % 5 = 0 THEN 3 ELSE 4 END AS n,
                     array_to_string(ws[1:len(ws) // 2], ' ') AS question,
                     array_to_string(ws[len(ws) // 2 + 1:], ' ') AS tail
              FROM (SELECT item_id,
                           list_filter(regexp_split_to_array(text, '[ \t\n\r\f]+'), lambda x: x <> '') AS ws
                    FROM benchmark))
        WINDOW s AS (ORDER BY item_id)""",
    "arc1": """
        SELECT item_id, n, question, labels,
               list_concat(list_concat(nxt[1:gold], [tail]), nxt[gold + 1:n - 1]) AS texts,
               CASE WHEN item_id % 7 = 1 AND item_id % 3 <> 0 THEN CAST(gold + 1 AS VARCHAR)
                    ELSE labels[gold + 1] END AS key
        FROM arc0 WHERE len(nxt) >= n - 1""",
    "arc2": """
        SELECT *, list_position(labels, key) AS direct,
               list_position(labels, CASE key WHEN '1' THEN 'A' WHEN '2' THEN 'B' WHEN '3' THEN 'C'
                                     WHEN '4' THEN 'D' ELSE key END) AS mapped
        FROM arc1""",
    "arc": f"""
        SELECT 'arc_easy' AS source, 'test' AS split, item_id, {strip('question')} AS context,
               NULL AS answer, list_transform(texts, lambda x: {strip('x')}) AS choices,
               CAST(CASE WHEN direct > 0 THEN direct - 1 WHEN mapped > 0 THEN mapped - 1 END AS BIGINT) AS gold_idx
        FROM arc2""",
    "items": """
        SELECT source, split, item_id, context, choices, gold_idx FROM sciq
        UNION ALL SELECT source, split, item_id, context, choices, gold_idx FROM arc""",
    "ch": """
        SELECT source, split, item_id, gold_idx, context, unnest(choices) AS choice,
               CAST(generate_subscripts(choices, 1) - 1 AS BIGINT) AS choice_idx FROM items""",
    "sf0": f"""
        SELECT item_id, len(ctx) AS n_ctx, len(ans) AS n_ans, len(ctx) + len(ans) AS n_all,
               list_concat(ctx, ans) AS all_ids
        FROM (SELECT item_id, {byte_ids('context')} AS ctx,
                     list_concat({byte_ids("' ' || " + strip('answer'))}, [256]) AS ans
              FROM sciq WHERE split = 'train')""",
    "sf": """
        SELECT item_id, least(n_all, 256) AS n_ids,
               CASE WHEN n_all > 256 THEN greatest(0, 256 - n_ans) ELSE n_ctx END AS answer_start,
               all_ids[greatest(1, n_all - 255):n_all] AS ids
        FROM sf0""",
    "bt": f"""
        SELECT epoch, item_id, n_ids, answer_start,
               (row_number() OVER (PARTITION BY epoch
                    ORDER BY md5('{SEED}:' || epoch || ':' || item_id), item_id) - 1) // 16 AS batch
        FROM (SELECT *, unnest(range({SFT_EPOCHS})) AS epoch FROM sf)""",
    "sft_t": """
        SELECT * FROM (
            SELECT item_id, i, answer_start, y, lag(y) OVER s AS h1, lag(y, 2) OVER s AS h2
            FROM (SELECT item_id, answer_start, unnest(ids) AS y, generate_subscripts(ids, 1) - 1 AS i FROM sf)
            WINDOW s AS (PARTITION BY item_id ORDER BY i))
        WHERE i >= greatest(1, answer_start)""",
    "cnt_base": """
        SELECT h2, h1, y, count(*) AS n FROM wt WHERE split = 'train' GROUP BY ALL""",
    "cnt_sft": f"""
        SELECT h2, h1, y, {SFT_WEIGHT} * count(*) AS n FROM sft_t GROUP BY ALL""",
    "cnt1": "SELECT 'base' AS model, h2, h1, y, n FROM cnt_base",
    "cnt3": """
        SELECT 'base' AS model, h2, h1, y, n FROM cnt_base
        UNION ALL SELECT 'sft_only', h2, h1, y, n FROM cnt_sft
        UNION ALL SELECT 'finetuned', h2, h1, y, n
        FROM (SELECT * FROM cnt_base UNION ALL SELECT * FROM cnt_sft)""",
    "val_t": "SELECT shard_idx, w, h2, h1, y FROM wt WHERE split = 'val'",
    "train_t": "SELECT shard_idx, w, h2, h1, y FROM wt WHERE split = 'train'",
    "choice_t": f"""
        SELECT * FROM (
            SELECT source, split, item_id, gold_idx, choice_idx, n_ctx, n_choice, i, y,
                   lag(y) OVER s AS h1, lag(y, 2) OVER s AS h2
            FROM (SELECT *, unnest(list_concat(ctx, chs)) AS y,
                         generate_subscripts(list_concat(ctx, chs), 1) - 1 AS i
                  FROM (SELECT source, split, item_id, gold_idx, choice_idx, ctx, chs,
                               len(ctx) AS n_ctx, len(chs) AS n_choice
                        FROM (SELECT *, {byte_ids('context')} AS ctx,
                                     {byte_ids("' ' || " + strip('choice'))} AS chs FROM ch)))
            WINDOW s AS (PARTITION BY source, item_id, choice_idx ORDER BY i))
        WHERE i >= greatest(1, n_ctx)""",
}


def probabilities(counts: str, needed: str) -> dict[str, str]:
    """Parts that give ``pr`` (model, h2, h1, y, p) for the distinct contexts and tokens needed."""
    return {
        "c0": f"SELECT model, y, sum(n) AS n FROM {counts} GROUP BY ALL",
        "nn": f"SELECT model, sum(n) AS n FROM {counts} GROUP BY ALL",
        "c1": f"SELECT model, h1, y, sum(n) AS n FROM {counts} GROUP BY ALL",
        "n1": f"SELECT model, h1, sum(n) AS n FROM {counts} GROUP BY ALL",
        "c2": f"SELECT model, h2, h1, y, sum(n) AS n FROM {counts} WHERE h2 IS NOT NULL GROUP BY ALL",
        "n2": f"SELECT model, h2, h1, sum(n) AS n FROM {counts} WHERE h2 IS NOT NULL GROUP BY ALL",
        "pr0": f"""
            SELECT nn.model, k.h2, k.h1, k.y,
                   (coalesce(c0.n, 0) + 1e0) / (nn.n + 1e0 * 257) AS p0,
                   coalesce(c1.n, 0) AS c1, coalesce(n1.n, 0) AS n1,
                   coalesce(c2.n, 0) AS c2, coalesce(n2.n, 0) AS n2
            FROM (SELECT DISTINCT h2, h1, y FROM {needed}) k CROSS JOIN nn
            LEFT JOIN c0 ON c0.model = nn.model AND c0.y = k.y
            LEFT JOIN c1 ON c1.model = nn.model AND c1.h1 = k.h1 AND c1.y = k.y
            LEFT JOIN n1 ON n1.model = nn.model AND n1.h1 = k.h1
            LEFT JOIN c2 ON c2.model = nn.model AND c2.h2 = k.h2 AND c2.h1 = k.h1 AND c2.y = k.y
            LEFT JOIN n2 ON n2.model = nn.model AND n2.h2 = k.h2 AND n2.h1 = k.h1""",
        "pr1": """
            SELECT *, CASE WHEN n1 > 0 THEN 0.7e0 * (CAST(c1 AS DOUBLE) / n1) + (1e0 - 0.7e0) * p0
                           ELSE p0 END AS p1 FROM pr0""",
        "pr": """
            SELECT model, h2, h1, y,
                   CASE WHEN n2 > 0 THEN 0.7e0 * (CAST(c2 AS DOUBLE) / n2) + (1e0 - 0.7e0) * p1
                        ELSE p1 END AS p FROM pr1""",
    }


STREAM = ["o", "shards"]
TOKENS = [*STREAM, "tok", "wt"]
QA = ["turns", "sq0", "sciq"]
ITEMS = [*QA, "arc0", "arc1", "arc2", "arc", "items"]
SFT = [*QA, "sf0", "sf"]


def query(parts: list[str], body: str, probs: tuple[str, str] | None = None, extra=()) -> str:
    """WITH the named parts (each once), then probability parts, then ``extra``, then the body."""
    names = list(dict.fromkeys(parts))
    ctes = [(name, PARTS[name]) for name in names]
    if probs:
        ctes += list(probabilities(*probs).items())
    ctes += list(extra)
    with_ = ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in ctes)
    return f"WITH {with_}\n{body}" if with_ else body


def joined_probs(targets: str) -> str:
    return (
        f"{targets} t JOIN pr ON pr.h2 IS NOT DISTINCT FROM t.h2 AND pr.h1 = t.h1 AND pr.y = t.y"
    )


SCORES = (
    "sc",
    f"""SELECT model, source, split, item_id, gold_idx, choice_idx, sum(ln(p)) / any_value(n_choice) AS score
        FROM {joined_probs('choice_t')} GROUP BY model, source, split, item_id, gold_idx, choice_idx""",
)
PREDICTED = (
    "pd",
    """SELECT model, source, split, item_id, choice_idx AS pred_idx, gold_idx,
              coalesce(choice_idx = gold_idx, false) AS hit
       FROM (SELECT *, row_number() OVER (PARTITION BY model, source, split, item_id
                                          ORDER BY round(score, 12) DESC, choice_idx) AS r FROM sc)
       WHERE r = 1""",
)
ACCURACY = (
    "ac",
    """SELECT model, source, split, count(*) AS total, CAST(sum(CAST(hit AS INT)) AS BIGINT) AS correct,
              round(avg(CAST(hit AS DOUBLE)), 6) AS accuracy
       FROM pd GROUP BY ALL""",
)
BATCH_LOSS = f"""SELECT model, shard_idx, w // {B} AS batch, -avg(ln(p)) AS loss
    FROM {{targets}} GROUP BY model, shard_idx, w // {B}"""
SCORED = [*TOKENS, *SFT, *ITEMS, "ch", "sft_t", "cnt_base", "cnt_sft", "cnt3", "choice_t"]

# Next-token tables by brute force: every context against every id of the vocabulary.
CONTEXTS = (
    "ctxs",
    f"""SELECT DISTINCT CASE WHEN len(ids) >= 2 THEN ids[-2] END AS h2,
               CASE WHEN len(ids) >= 1 THEN ids[-1] END AS h1
        FROM (SELECT {byte_ids('context')} AS ids FROM items)""",
)
ALL_NEXT = ("nxt_all", "SELECT h2, h1, unnest(range(257)) AS y FROM ctxs")
KEPT = (
    "kept",
    f"""SELECT h, y AS w, r AS rnk, exp(ln(p)) / sum(exp(ln(p))) OVER (PARTITION BY h) AS p
        FROM (SELECT concat_ws(' ', h2, h1) AS h, y, p,
                     rank() OVER (PARTITION BY h2, h1 ORDER BY round(ln(p), 10) DESC) AS r FROM pr)
        WHERE r <= {TOP_K}""",
)


def next_token(body: str) -> str:
    names = list(dict.fromkeys([*TOKENS, "cnt_base", "cnt1", *ITEMS]))
    ctes = [(n, PARTS[n]) for n in names] + [CONTEXTS, ALL_NEXT]
    ctes += list(probabilities("cnt1", "nxt_all").items()) + [KEPT]
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({sql})" for n, sql in ctes) + "\n" + body


LEVELS = """
    SELECT CAST(0 AS BIGINT) AS k, '' AS h, CAST(y AS BIGINT) AS w, CAST(sum(n) AS BIGINT) AS n FROM {c} GROUP BY y
    UNION ALL SELECT 1, CAST(h1 AS VARCHAR), y, CAST(sum(n) AS BIGINT) FROM {c} GROUP BY h1, y
    UNION ALL SELECT 2, h2 || ' ' || h1, y, CAST(sum(n) AS BIGINT) FROM {c} WHERE h2 IS NOT NULL GROUP BY h2, h1, y"""

MANIFEST = query(
    STREAM,
    """SELECT shard_idx, split, 'fineweb_edu_' || split || '_' || printf('%06d', shard_idx) AS file_stem,
              n AS n_tokens, 2 * n AS n_bytes FROM shards""",
)


LAYOUT = f"""SELECT rank, micro_step // {GRAD_ACCUM} AS step, count(*) AS n_micro,
       count(*) * {BT} AS n_tokens, arg_min(shard_idx, micro_step) AS first_shard,
       arg_max(shard_idx, micro_step) AS last_shard,
       (micro_step // {GRAD_ACCUM}) % 250 = 0 AS is_val,
       (micro_step // {GRAD_ACCUM}) % 10 = 0 AS is_log
FROM sched WHERE split = 'train' AND micro_step // {GRAD_ACCUM} <
     (SELECT sum(n) FROM shards WHERE split = 'train') // {BATCH_TOKENS}
GROUP BY rank, micro_step // {GRAD_ACCUM}"""

STEP_LOSS = query(
    [*TOKENS, "lp", "sched", "cnt_base", "cnt1", "train_t"],
    f"""SELECT step, round(avg(loss), 6) AS loss
        FROM (SELECT micro_step // {GRAD_ACCUM} AS step, rank, avg(loss) AS loss
              FROM sched JOIN bl ON bl.shard_idx = sched.shard_idx AND bl.batch = pos // {BT}
              WHERE split = 'train' AND micro_step // {GRAD_ACCUM} <
                    (SELECT sum(n) FROM shards WHERE split = 'train') // {BATCH_TOKENS}
              GROUP BY micro_step // {GRAD_ACCUM}, rank)
        GROUP BY step""",
    probs=("cnt1", "train_t"),
    extra=[("bl", BATCH_LOSS.format(targets=joined_probs("train_t")))],
)

TRAINING_BATCHES = query(
    [*TOKENS, "lp", "sched"],
    f"""SELECT rank, micro_step // {GRAD_ACCUM} AS step, micro_step, w % {B} AS row_in_batch,
               CAST(sum(h1) AS BIGINT) AS sum_x, CAST(sum(y) AS BIGINT) AS sum_y,
               CAST(arg_min(h1, q) AS BIGINT) AS first_id, CAST(arg_max(y, q) AS BIGINT) AS last_id
        FROM wt JOIN sched ON sched.shard_idx = wt.shard_idx AND w // {B} = pos // {BT}
        WHERE sched.split = 'train' AND epoch = 0
        GROUP BY rank, micro_step, wt.shard_idx, w""",
)

RUN_THROUGHPUT = f"""
    SELECT run_id, step, round({BATCH_TOKENS * 10}e0 / dt, 6) AS tokens_per_sec,
           round(dt / 10e0 * 1000e0, 6) AS ms_per_step
    FROM (SELECT run_id, step,
                 (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY run_id ORDER BY step)) / 1e6 AS dt
          FROM (SELECT user_id AS run_id, ts,
                       row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS step
                FROM events)
          WHERE step % 10 = 0)"""

# A symbol is its id beyond this code point, so that no byte is a control sign in SQL text.
SYMBOLS = 1024


def merge_chain() -> list[tuple[str, str]]:
    """One pair count and one replacement per merge: (m1, w1), (m2, w2), .."""
    words = f"""
        SELECT word, count(*) AS n,
               array_to_string(list_transform({byte_ids("word")}, lambda x: chr(x + {SYMBOLS})), '') AS c
        FROM (SELECT unnest(regexp_extract_all(text, '{PRETOKEN_PATTERN}')) AS word FROM documents)
        GROUP BY word"""
    chain = [("w0", words)]
    for k in range(1, MERGES + 1):
        top = f"""
            SELECT p, CAST(sum(n) AS BIGINT) AS n
            FROM (SELECT n, substr(c, unnest(range(1, length(c))), 2) AS p FROM w{k - 1})
            GROUP BY p ORDER BY sum(n) DESC, p LIMIT 1"""
        merged = f"SELECT word, w{k - 1}.n, replace(c, p, chr({SYMBOLS + 255 + k})) AS c FROM w{k - 1}, m{k}"
        chain += [(f"m{k}", top), (f"w{k}", merged)]
    return chain


def all_sql() -> dict[str, str]:
    return {
        "bpe_merges": query(
            [],
            " UNION ALL ".join(
                f"""SELECT CAST({k - 1} AS BIGINT) AS rank, CAST(unicode(p[1]) - {SYMBOLS} AS BIGINT) AS "left",
                           CAST(unicode(p[2]) - {SYMBOLS} AS BIGINT) AS "right",
                           CAST({255 + k} AS BIGINT) AS new_id, n FROM m{k}"""
                for k in range(1, MERGES + 1)
            ),
            extra=merge_chain(),
        ),
        "doc_token_counts_bpe": query(
            [],
            f"""SELECT doc_id, CAST(1 + coalesce(sum(length(c)), 0) AS BIGINT) AS n_tokens
                FROM documents
                LEFT JOIN (SELECT doc_id, unnest(regexp_extract_all(text, '{PRETOKEN_PATTERN}')) AS word
                           FROM documents) USING (doc_id)
                LEFT JOIN w{MERGES} USING (word) GROUP BY doc_id""",
            extra=merge_chain(),
        ),
        "resumed_layout": query(
            [*STREAM, "lp", "sched"], f"SELECT * FROM ({LAYOUT}) WHERE step >= {RESUME_STEP}"
        ),
        "training_batches": TRAINING_BATCHES,
        "stored_batches": TRAINING_BATCHES,
        "written_shards": MANIFEST,
        "doc_token_counts": "SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS n_tokens FROM documents",
        "corpus_totals": f"""
            SELECT count(*) AS n_docs, CAST(sum(len(ids)) AS BIGINT) AS n_tokens,
                   CAST((sum(len(ids)) + {SHARD - 1}) // {SHARD} AS BIGINT) AS n_shards,
                   CAST(max(list_max(ids)) AS BIGINT) AS max_id
            FROM (SELECT list_concat([256], {byte_ids('text')}) AS ids FROM documents)""",
        "doc_offsets": query(["o"], "SELECT doc_id, start, n AS n_tokens FROM o"),
        "shard_pieces": query(["o", "pieces"], "SELECT * FROM pieces"),
        "spilled_docs": query(
            ["o", "pieces"],
            "SELECT doc_id, count(*) AS n_pieces FROM pieces GROUP BY doc_id HAVING count(*) > 1",
        ),
        "shard_manifest": MANIFEST,
        "stream_manifest": MANIFEST,
        "pretoken_dictionary": f"""
            SELECT word, count(*) AS n
            FROM (SELECT unnest(regexp_extract_all(text, '{PRETOKEN_PATTERN}')) AS word FROM documents)
            GROUP BY word""",
        "token_unigrams": f"""
            SELECT CAST(id AS BIGINT) AS token_id, count(*) AS n
            FROM (SELECT unnest(list_concat([256], {byte_ids('text')})) AS id FROM documents) GROUP BY id""",
        "window_summary": query(
            TOKENS,
            """SELECT shard_idx, w, CAST(sum(h1) AS BIGINT) AS sum_x, CAST(sum(y) AS BIGINT) AS sum_y,
                      CAST(arg_min(h1, q) AS BIGINT) AS first_id, CAST(arg_max(y, q) AS BIGINT) AS last_id
               FROM wt GROUP BY shard_idx, w""",
        ),
        "loader_plan": query(
            [*STREAM, "lp"],
            f"""SELECT split, rank, shard_idx, CAST(n_batches AS BIGINT) AS n_batches,
                       CAST(n - {BT} * sum(n_batches) OVER (PARTITION BY shard_idx) AS BIGINT) AS unused_tokens
                FROM lp""",
        ),
        "loader_schedule": query(
            [*STREAM, "lp", "sched"],
            "SELECT rank, micro_step, epoch, shard_idx, pos FROM sched WHERE split = 'train'",
        ),
        "val_batches": query(
            [*STREAM, "lp", "sched"],
            """SELECT rank, micro_step, shard_idx, pos FROM sched
               WHERE split = 'val' AND micro_step < 20""",
        ),
        "step_layout": query([*STREAM, "lp", "sched"], LAYOUT),
        "mcq_items": query(
            [*ITEMS, "ch"], "SELECT source, split, item_id, choice_idx, context, choice FROM ch"
        ),
        "mcq_labels": query(
            ["arc0", "arc1", "arc2"],
            """SELECT item_id, CAST(len(texts) AS BIGINT) AS n_choices,
                      CAST(CASE WHEN direct > 0 THEN direct - 1 WHEN mapped > 0 THEN mapped - 1 END AS BIGINT) AS gold_idx,
                      coalesce(direct, 0) = 0 AND coalesce(mapped, 0) > 0 AS used_fallback
               FROM arc2""",
        ),
        "split_counts": query(ITEMS, "SELECT source, split, count(*) AS n FROM items GROUP BY ALL"),
        "sft_examples": query(
            SFT,
            """SELECT item_id, n_ids, answer_start, n_ids - answer_start AS n_loss,
                      CAST(list_sum(ids) AS BIGINT) AS id_sum FROM sf""",
        ),
        "sft_batches": query(
            [*SFT, "bt"],
            """SELECT epoch, batch, count(*) AS n_rows, max(n_ids) AS max_len,
                      CAST(count(*) * max(n_ids) - sum(n_ids) AS BIGINT) AS n_pad,
                      CAST(sum(n_ids - greatest(1, answer_start)) AS BIGINT) AS n_loss
               FROM bt GROUP BY epoch, batch""",
        ),
        "ngram_counts": query([*TOKENS, "cnt_base"], LEVELS.format(c="cnt_base")),
        "ngram_counts_ft": query(
            [*TOKENS, *SFT, "sft_t", "cnt_base", "cnt_sft"],
            LEVELS.format(c="both_cnt"),
            extra=[("both_cnt", "SELECT * FROM cnt_base UNION ALL SELECT * FROM cnt_sft")],
        ),
        "token_logprob": query(
            [*TOKENS, "cnt_base", "cnt1", "val_t"],
            f"""SELECT shard_idx, w, count(*) AS n_targets, round(sum(ln(p)), 6) AS sum_logp
                FROM {joined_probs('val_t')} GROUP BY shard_idx, w""",
            probs=("cnt1", "val_t"),
        ),
        "val_loss_ppl": query(
            [*TOKENS, *SFT, "sft_t", "cnt_base", "cnt_sft", "cnt3", "val_t"],
            f"""SELECT model, round(-avg(ln(p)), 6) AS loss, round(exp(-avg(ln(p))), 6) AS ppl
                FROM {joined_probs('val_t')} GROUP BY model""",
            probs=("cnt3", "val_t"),
        ),
        "val_loss_steps": query(
            [*TOKENS, "lp", "sched", *SFT, "sft_t", "cnt_base", "cnt_sft", "cnt3", "val_t"],
            f"""SELECT model, round(avg(loss), 6) AS loss, round(exp(avg(loss)), 6) AS ppl
                FROM (SELECT model, rank, avg(loss) AS loss
                      FROM sched JOIN bl ON bl.shard_idx = sched.shard_idx AND bl.batch = pos // {BT}
                      WHERE split = 'val' AND micro_step < 20 GROUP BY model, rank)
                GROUP BY model""",
            probs=("cnt3", "val_t"),
            extra=[("bl", BATCH_LOSS.format(targets=joined_probs("val_t")))],
        ),
        "masked_loss": query(
            [*TOKENS, *SFT, "bt", "sft_t", "cnt_base", "cnt1"],
            f"""SELECT epoch, batch, round(-sum(ln(p)) / count(*), 6) AS loss
                FROM bt JOIN (SELECT item_id, p FROM {joined_probs('sft_t')}) USING (item_id)
                GROUP BY epoch, batch""",
            probs=("cnt1", "sft_t"),
        ),
        "step_loss": STEP_LOSS,
        "step_metrics": f"""
            SELECT 'pass-0' AS run_id, step, 'train_loss' AS name, loss AS value FROM ({STEP_LOSS})""",
        "choice_scores": query(
            SCORED,
            "SELECT model, source, split, item_id, choice_idx, round(score, 6) AS score FROM sc",
            probs=("cnt3", "choice_t"),
            extra=[SCORES],
        ),
        "mcq_predictions": query(
            SCORED,
            "SELECT * FROM pd",
            probs=("cnt3", "choice_t"),
            extra=[SCORES, PREDICTED],
        ),
        "mcq_accuracy": query(
            SCORED,
            "SELECT * FROM ac",
            probs=("cnt3", "choice_t"),
            extra=[SCORES, PREDICTED, ACCURACY],
        ),
        "validation_accuracy": query(
            SCORED,
            "SELECT * FROM ac",
            probs=("cnt3", "choice_t"),
            extra=[
                SCORES,
                (
                    "pd0",
                    """SELECT * FROM sc WHERE source = 'sciq' AND item_id IN
                       (SELECT item_id FROM sciq WHERE split = 'validation' ORDER BY item_id LIMIT 500)""",
                ),
                ("pd", PREDICTED[1].replace("FROM sc)", "FROM pd0)")),
                ACCURACY,
            ],
        ),
        "results_table": query(
            SCORED,
            """SELECT model, source || ' (' || split || ')' AS dataset, correct, total, accuracy FROM ac
               UNION ALL
               SELECT DISTINCT 'random baseline', source || ' (' || split || ')', CAST(NULL AS BIGINT),
                      CAST(NULL AS BIGINT), 0.25e0 FROM ac""",
            probs=("cnt3", "choice_t"),
            extra=[SCORES, PREDICTED, ACCURACY],
        ),
        "stored_results": query(
            SCORED,
            "SELECT model, source || ' (' || split || ')' AS dataset, correct, total, accuracy FROM ac",
            probs=("cnt3", "choice_t"),
            extra=[SCORES, PREDICTED, ACCURACY],
        ),
        "user_choice_scores": query(
            [*ITEMS, "ch"],
            f"""SELECT 'user' AS model, source, split, item_id, choice_idx,
                       round((-list_sum(list_transform(ids, lambda x: ln(x + 2e0)))
                              - ln(1e0 + coalesce(list_sum(
                                    ctx[greatest(1, len(ctx) + len(ids) - {USER_CONTEXT - 1}):len(ctx)]), 0)))
                             / len(ids), 6) AS score
                FROM (SELECT *, all_ids[greatest(1, len(all_ids) - {USER_CONTEXT - 1}):len(all_ids)] AS ids
                      FROM (SELECT *, {byte_ids("' ' || " + strip('choice'))} AS all_ids,
                                   {byte_ids('context')} AS ctx FROM ch))""",
        ),
        "next_token_topk": next_token(
            "SELECT h, CAST(w AS BIGINT) AS w, rnk, round(p, 9) AS p FROM kept"
        ),
        "next_token_draw": next_token(
            f"""SELECT h, CAST(arg_min(w, place) AS BIGINT) AS w
                FROM (SELECT *, sum(p) OVER s AS cdf, row_number() OVER s AS place,
                             count(*) OVER (PARTITION BY h) AS size,
                             CAST('0x' || substr(md5('{SEED}:' || h), 1, 13) AS BIGINT) / 4503599627370496e0 AS u
                      FROM kept
                      WINDOW s AS (PARTITION BY h ORDER BY round(ln(p), 10) DESC, w
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
                WHERE cdf > u OR place = size GROUP BY h"""
        ),
        "run_throughput": RUN_THROUGHPUT,
        "stored_throughput": RUN_THROUGHPUT,
    }
