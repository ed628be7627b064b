"""For each query the same result as plain SQL over the test tables."""

from __future__ import annotations

# The parts below are common table expressions; `_sql` puts those a query needs in front.
_PARTS = {
    "paired": """
        SELECT conv_id, turn, role, text,
               LEAD(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
               LEAD(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS next_turn,
               LEAD(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
        FROM conversations""",
    "instructions": """
        SELECT p.conv_id * 4294967296 + p.turn AS id, p.text AS instruction, p.next_text AS response,
               s.text AS context,
               CASE WHEN p.turn <= 1 THEN 'opening' ELSE 'followup' END AS category,
               CASE WHEN (p.conv_id + p.turn) % 10 = 0 THEN 'test' ELSE 'train' END AS split
        FROM paired p
        LEFT JOIN (SELECT conv_id, text FROM conversations WHERE role = 'system') s
          ON p.conv_id = s.conv_id
        WHERE p.role = 'user' AND p.next_role = 'assistant' AND p.next_turn = p.turn + 1""",
    # The words and the layout of the prompt.
    "prompts": """
        SELECT *, CASE WHEN context <> '' THEN
            'Below is an instruction that describes a task. Write a response that appropriately completes the request.'
            || chr(10) || '    ' || chr(10) || '    ### Instruction:' || chr(10) || '    ' || coalesce(instruction, 'None')
            || chr(10) || '    ' || chr(10) || '    Input:' || chr(10) || '    ' || context
            || chr(10) || '    ' || chr(10) || '    ### Response:' || chr(10) || '    ' || coalesce(response, 'None')
            || chr(10) || '    ' || chr(10) || '    ### End'
          ELSE
            'Below is an instruction that describes a task. Write a response that appropriately completes the request.'
            || chr(10) || '    ' || chr(10) || '    ### Instruction:' || chr(10) || '    ' || coalesce(instruction, 'None')
            || chr(10) || '    ' || chr(10) || '    ### Response:' || chr(10) || '    ' || coalesce(response, 'None')
            || chr(10) || '    ' || chr(10) || '    ### End'
          END AS text
        FROM instructions""",
    "doc_texts": "SELECT doc_id AS id, text FROM documents",
    "seq": "SELECT id, ROW_NUMBER() OVER (ORDER BY id) - 1 AS seq FROM instructions",
    "sequential": "SELECT id, seq, seq // 4 AS batch_id, CAST(seq % 4 AS INT) AS slot FROM seq",
    "dealt": """
        SELECT CAST((v // 4) % 4 AS INT) AS rank, v // 16 AS step, CAST(v % 4 AS INT) AS slot,
               id, v // 4 AS batch_id
        FROM (SELECT COUNT(*) AS n FROM seq),
             range(0, ((n + 15) // 16) * 16) AS r(v)
        JOIN seq ON seq.seq = r.v % n""",
    "manual": """
        SELECT batch_id, slot, id,
               list_resize(input_ids, longest, 2) AS input_ids,
               list_resize(list_transform(input_ids, lambda x: 1), longest, 0) AS attention_mask
        FROM (SELECT s.batch_id, s.slot, t.*, MAX(t.n_tokens) OVER (PARTITION BY s.batch_id) AS longest
              FROM sequential s JOIN tokens t ON s.id = t.id)""",
    "labelled": """
        SELECT *, list_transform(input_ids, lambda x: CASE WHEN x = 2 THEN -100 ELSE x END) AS labels
        FROM manual""",
    "pairs": """
        SELECT batch_id, slot, id, input_ids[i] AS prev, labels[i + 1] AS next, i
        FROM (SELECT *, unnest(range(1, len(input_ids))) AS i FROM labelled)
        WHERE labels[i + 1] <> -100""",
    "lengths": "SELECT id, n_tokens FROM tokens",
    "shuffled": """
        SELECT id, n_tokens, COUNT(*) OVER () AS n,
               ROW_NUMBER() OVER (ORDER BY md5('7:' || CAST(id AS VARCHAR)), id) AS rn
        FROM lengths""",
    "mega": """
        SELECT *, greatest(1, least(n // 16, 50)) * 4 AS m, (rn - 1) // m AS mb
        FROM shuffled""",
    "sorted_mega": """
        SELECT id, n_tokens, rn,
               mb * m + ROW_NUMBER() OVER (PARTITION BY mb ORDER BY n_tokens DESC, rn) - 1 AS old_seq
        FROM mega""",
    "longest": "SELECT id, old_seq FROM sorted_mega ORDER BY n_tokens DESC, rn LIMIT 1",
    "grouped": """
        SELECT g.id, g.n_tokens,
               CASE WHEN g.id = l.id THEN 0 WHEN g.old_seq = 0 THEN l.old_seq ELSE g.old_seq END AS seq
        FROM sorted_mega g, longest l""",
    "grouped_dealt": """
        SELECT CAST((v // 4) % 4 AS INT) AS rank, v // 16 AS step, CAST(v % 4 AS INT) AS slot,
               id, v // 4 AS batch_id
        FROM (SELECT COUNT(*) AS n FROM grouped),
             range(0, ((n + 15) // 16) * 16) AS r(v)
        JOIN grouped ON grouped.seq = r.v % n""",
    "trainer": """
        SELECT rank, step, slot, id,
               list_resize(input_ids, longest, 2) AS input_ids,
               list_resize(list_transform(input_ids, lambda x: 1), longest, 0) AS attention_mask,
               list_transform(list_resize(input_ids, longest, 2),
                              lambda x: CASE WHEN x = 2 THEN -100 ELSE x END) AS labels
        FROM (SELECT d.rank, d.step, d.slot, t.*, MAX(t.n_tokens) OVER (PARTITION BY d.batch_id) AS longest
              FROM grouped_dealt d JOIN tokens t ON d.id = t.id)""",
    # The same over two epochs, each shuffled by a seed of its own.
    "epoch_shuffled": """
        SELECT id, n_tokens, e AS epoch, COUNT(*) OVER (PARTITION BY e) AS n,
               ROW_NUMBER() OVER (PARTITION BY e ORDER BY md5('7:' || CAST(e AS VARCHAR) || ':' || CAST(id AS VARCHAR)), id) AS rn
        FROM lengths CROSS JOIN range(2) AS epochs(e)""",
    "epoch_mega": """
        SELECT *, greatest(1, least(n // 16, 50)) * 4 AS m, (rn - 1) // m AS mb
        FROM epoch_shuffled""",
    "epoch_sorted": """
        SELECT epoch, id, n_tokens, rn, n,
               mb * m + ROW_NUMBER() OVER (PARTITION BY epoch, mb ORDER BY n_tokens DESC, rn) - 1 AS old_seq,
               ROW_NUMBER() OVER (PARTITION BY epoch ORDER BY n_tokens DESC, rn) = 1 AS longest
        FROM epoch_mega""",
    "epoch_grouped": """
        SELECT g.epoch, g.id, g.n, CASE WHEN g.longest THEN 0 WHEN g.old_seq = 0 THEN l.old_seq ELSE g.old_seq END AS seq
        FROM epoch_sorted g JOIN epoch_sorted l ON l.epoch = g.epoch AND l.longest""",
    "epoch_dealt": """
        SELECT epoch, CAST((v // 4) % 4 AS INT) AS rank, v // 16 AS step, CAST(v % 4 AS INT) AS slot, id, v // 4 AS batch_id
        FROM (SELECT COUNT(*) AS n FROM lengths) AS c, range(0, ((c.n + 15) // 16) * 16) AS r(v)
        JOIN epoch_grouped ON epoch_grouped.seq = r.v % c.n""",
    "epoch_trainer": """
        SELECT epoch, rank, step, slot, id, list_resize(input_ids, longest, 2) AS input_ids,
               list_transform(list_resize(input_ids, longest, 2), lambda x: CASE WHEN x = 2 THEN -100 ELSE x END) AS labels
        FROM (SELECT d.epoch, d.rank, d.step, d.slot, t.*, MAX(t.n_tokens) OVER (PARTITION BY d.epoch, d.batch_id) AS longest
              FROM epoch_dealt d JOIN tokens t ON d.id = t.id)""",
    "metrics": """
        SELECT run_id, rank, key, value, global_step,
               CAST((global_step - 1) // 20 AS INT) AS epoch, (global_step - 1) % 20 AS step
        FROM (SELECT user_id AS run_id, CAST(user_id % 4 AS INT) AS rank, event_type AS key, value,
                     ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS global_step
              FROM events)""",
    "runs": """
        SELECT DISTINCT user_id AS run_id,
               CASE WHEN user_id % 4 = 0 THEN NULL ELSE user_id - user_id % 4 END AS parent_run_id,
               CAST(user_id % 4 AS INT) AS rank,
               CAST(user_id % 8 + 1 AS INT) AS gpus, CAST(user_id % 3 + 1 AS INT) AS nodes,
               ['stage_1', 'stage_2', 'stage_3', 'stage_3_offload'][user_id // 4 % 4 + 1] AS stage,
               'tuning_run' AS run_name
        FROM events""",
    # The engine's configuration as it is shown.
    "base_values": """
        SELECT * FROM (VALUES
          ('train_micro_batch_size_per_gpu', '4'),
          ('gradient_accumulation_steps', '1'),
          ('gradient_clipping', '0.3'),
          ('bf16', '{"enabled":"true"}'),
          ('optimizer', '{"params":{"betas":[0.9,0.999],"eps":1.0E-8,"lr":0.0002},"type":"AdamW"}'),
          ('scheduler', '{"params":{"warmup_max_lr":0.0002,"warmup_min_lr":0,"warmup_num_steps":100,"warmup_type":"linear"},"type":"WarmupLR"}'),
          ('steps_per_print', '10'),
          ('wall_clock_breakdown', 'true')) AS v(key, value)""",
    # The memory sections as they are shown.
    "zero_values": """
        SELECT * FROM (VALUES
          ('stage_1', '{"allgather_bucket_size":500000000,"allgather_partitions":true,"contiguous_gradients":true,"cpu_offload":false,"overlap_comm":true,"reduce_bucket_size":500000000,"reduce_scatter":true,"stage":1}'),
          ('stage_2', '{"reduce_bucket_size":"auto","stage":2,"sub_group_size":1000000000}'),
          ('stage_3', '{"reduce_bucket_size":"auto","stage":3,"stage3_gather_16bit_weights_on_model_save":true,"stage3_max_live_parameters":10000000,"stage3_max_reuse_distance":10000000,"stage3_param_persistence_threshold":"auto","stage3_prefetch_bucket_size":"auto","sub_group_size":1000000000}'),
          ('stage_3_offload', '{"contiguous_gradients":true,"offload_optimizer":{"device":"cpu"},"offload_param":{"device":"cpu"},"overlap_comm":true,"reduce_bucket_size":"auto","stage":3,"stage3_gather_16bit_weights_on_model_save":true,"stage3_max_live_parameters":10000000,"stage3_max_reuse_distance":10000000,"stage3_param_persistence_threshold":"auto","stage3_prefetch_bucket_size":"auto","sub_group_size":1000000000}')
        ) AS v(stage, value)""",
    "run_configs": """
        SELECT r.run_id, r.stage, r.rank, b.key, b.value FROM runs r CROSS JOIN base_values b
        UNION ALL
        SELECT r.run_id, r.stage, r.rank, 'zero_optimization', z.value
        FROM runs r JOIN zero_values z ON r.stage = z.stage
        UNION ALL
        SELECT run_id, stage, rank, 'train_batch_size', CAST(gpus * nodes * 4 AS VARCHAR) FROM runs""",
    # One number is shown in another notation here.
    "leaves": """
        SELECT run_id, stage, run_configs.key || substr(t.fullkey, 2) AS key, CASE WHEN t.type = 'ARRAY' THEN CAST(t.value AS VARCHAR) ELSE replace(t.value ->> '$', '1e-8', '1.0E-8') END AS value
        FROM run_configs, json_tree(CAST(run_configs.value AS JSON)) AS t
        WHERE t.type <> 'OBJECT' AND t.fullkey NOT LIKE '%[%'""",
    # The trainer's arguments as they are shown.
    "trainer_values": """
        SELECT * FROM (VALUES
          ('per_device_train_batch_size', '4'), ('gradient_accumulation_steps', '1'),
          ('optim', 'paged_adamw_32bit'), ('save_steps', '50'), ('logging_steps', '10'),
          ('learning_rate', '0.0002'), ('bf16', 'true'), ('max_grad_norm', '0.3'),
          ('num_train_epochs', '2'), ('warmup_steps', '100'), ('group_by_length', 'true'),
          ('lr_scheduler_type', 'constant'),
          ('ddp_find_unused_parameters', 'false'), ('output_dir', '/models/results'),
          ('run_name', 'tuning_run')) AS v(key, value)""",
    # Both sides of the keys that have to agree, as they are shown.
    "key_pairs": """
        SELECT * FROM (VALUES
          ('per_device_train_batch_size', 'train_micro_batch_size_per_gpu', '4', '4'),
          ('gradient_accumulation_steps', 'gradient_accumulation_steps', '1', '1'),
          ('max_grad_norm', 'gradient_clipping', '0.3', '0.3'),
          ('bf16', 'bf16.enabled', 'true', 'true'),
          ('optim', 'optimizer.type', 'paged_adamw_32bit', 'AdamW'),
          ('learning_rate', 'optimizer.params.lr', '0.0002', '0.0002'),
          ('learning_rate', 'scheduler.params.warmup_max_lr', '0.0002', '0.0002'),
          ('warmup_steps', 'scheduler.params.warmup_num_steps', '100', '100'),
          ('lr_scheduler_type', 'scheduler.type', 'constant', 'WarmupLR'),
          ('betas', 'optimizer.params.betas', '[0.9, 0.999]', '[0.9,0.999]')
        ) AS v(trainer_key, engine_key, trainer_base, engine_value)""",
    "param_pairs": """
        SELECT run_id, trainer_key, engine_key,
               CASE WHEN trainer_key = 'learning_rate' AND run_id % 7 = 0 THEN 'auto'
                    WHEN trainer_key = 'learning_rate' AND run_id % 5 = 0 THEN '0.001'
                    WHEN trainer_key = 'betas' AND run_id % 3 = 0 THEN '[0.9, 0.95]'
                    WHEN trainer_key = 'per_device_train_batch_size' AND run_id % 11 = 0 THEN '4 | 8'
                    ELSE trainer_base END AS trainer_value,
               engine_value
        FROM runs CROSS JOIN key_pairs""",
    "repo_files": """
        SELECT regexp_extract(url, '^https?://([^/]+)/(.*)$', 1) AS repo,
               regexp_extract(url, '^https?://([^/]+)/(.*)$', 2) AS name,
               starts_with(url, 'https:') AS present
        FROM pages""",
    "models": """
        SELECT 'lib-' || repo AS lib, repo FROM (SELECT DISTINCT repo FROM repo_files)
        UNION ALL
        SELECT 'also-' || repo, repo FROM (SELECT DISTINCT repo FROM repo_files) WHERE length(repo) % 2 = 0""",
    "manifest": """
        SELECT lib, f.repo, name, '/models/' || lib || '/' || name AS target_path, present
        FROM repo_files f JOIN models m ON f.repo = m.repo""",
}


def _token_parts(source: str) -> dict[str, str]:
    """Vocabulary and token rows of the texts in `source`."""
    return {
        "split_texts": rf"""
        SELECT id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}\s]') AS toks
        FROM {source}""",
        "exploded": """
        SELECT id, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM split_texts""",
        "vocabulary": """
        SELECT token, CAST(ROW_NUMBER() OVER (ORDER BY n DESC, token) + 2 AS INT) AS token_id
        FROM (SELECT token, COUNT(*) AS n FROM exploded GROUP BY token ORDER BY n DESC, token LIMIT 8000)""",
        "encoded": """
        SELECT e.id, list(coalesce(v.token_id, 0) ORDER BY e.pos) AS ids
        FROM exploded e LEFT JOIN vocabulary v ON e.token = v.token GROUP BY e.id""",
        "all_tokens": f"""
        SELECT s.id, list_concat([1], coalesce(e.ids, [])) AS all_ids
        FROM {source} s LEFT JOIN encoded e ON s.id = e.id""",
        "tokens": """
        SELECT id, all_ids[1:512] AS input_ids, CAST(len(all_ids[1:512]) AS INT) AS n_tokens
        FROM all_tokens""",
    }


# Rows of a batch packed by first fit, one row a round: `used` are the packs' lengths, `places` the packs taken.
_PACK_PARTS = {
    "batch_lists": """
        SELECT batch_id, list(t.input_ids ORDER BY slot) AS lists, MAX(t.n_tokens) AS room
        FROM sequential s JOIN tokens t ON s.id = t.id GROUP BY batch_id""",
    "packing": """
        SELECT batch_id, lists, room, 0 AS done, CAST([] AS BIGINT[]) AS used, CAST([] AS BIGINT[]) AS places FROM batch_lists
        UNION ALL
        SELECT batch_id, lists, room, done + 1,
               CASE WHEN p IS NULL THEN list_append(used, n) ELSE list_transform(used, lambda u, i: CASE WHEN i = p THEN u + n ELSE u END) END,
               list_append(places, coalesce(p, len(used) + 1))
        FROM (SELECT *, len(lists[done + 1]) AS n,
                     nullif(coalesce(list_position(list_transform(used, lambda u: u + len(lists[done + 1]) <= room), true), 0), 0) AS p
              FROM packing WHERE done < len(lists))""",
    "packs": """
        SELECT batch_id, CAST(place - 1 AS INT) AS pack, room, list(ids ORDER BY nth) AS packed
        FROM (SELECT batch_id, room, unnest(places) AS place, unnest(lists) AS ids, generate_subscripts(places, 1) AS nth
              FROM packing WHERE done = len(lists))
        GROUP BY batch_id, place, room""",
}

# Byte-pair coding of the prompts. The last blank of white space before a word belongs to that word, so
# texts are cut there first; \s is spelled out, as here it knows ASCII only.
_BLANK = r"\t-\r \x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_SUBWORD_PARTS = {
    "ranks": """
        SELECT hex(from_base64(split_part(line, ' ', 1))) AS piece, CAST(split_part(line, ' ', 2) AS INT) AS token_id
        FROM (SELECT unnest(string_split(trim(content, chr(10)), chr(10))) AS line
              FROM read_text('/opt/tokenizers/byte_bpe_50k.tiktoken'))""",
    "word_lists": rf"""
        SELECT id, flatten(list_transform(
            string_split(regexp_replace(text, '([{_BLANK}])([{_BLANK}][^{_BLANK}])', '\1' || chr(1) || '\2', 'g'), chr(1)),
            lambda s: regexp_extract_all(s, '''(?:s|t|re|ve|m|ll|d)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_BLANK}\p{{L}}\p{{N}}]+|[{_BLANK}]+')
        )) AS words FROM prompts""",
    "placed_words": "SELECT id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM word_lists",
    # One pair of each word is joined in each round: the one of lowest rank, the first of equals.
    "merging": """
        SELECT word, list_transform(range(1, octet_length(encode(word)) + 1), lambda i: substr(hex(encode(word)), 2 * i - 1, 2)) AS parts
        FROM (SELECT DISTINCT word FROM placed_words)
        UNION ALL
        SELECT word, list_concat(list_concat(parts[1:k - 1], [parts[k] || parts[k + 1]]), parts[k + 2:])
        FROM (SELECT m.word, m.parts, arg_min(m.i, CAST(r.token_id AS BIGINT) * 1000000 + m.i) AS k
              FROM (SELECT word, parts, unnest(range(1, len(parts))) AS i FROM merging) AS m
              JOIN ranks AS r ON r.piece = m.parts[m.i] || m.parts[m.i + 1]
              GROUP BY m.word, m.parts)""",
    "word_ids": """
        SELECT word, list(token_id ORDER BY j) AS ids
        FROM (SELECT word, unnest(parts) AS piece, generate_subscripts(parts, 1) AS j
              FROM (SELECT word, arg_min(parts, len(parts)) AS parts FROM merging GROUP BY word))
        JOIN ranks USING (piece) GROUP BY word""",
    "tokens": """
        SELECT id, input_ids, CAST(len(input_ids) AS INT) AS n_tokens
        FROM (SELECT id, flatten(list(ids ORDER BY pos))[1:512] AS input_ids FROM placed_words JOIN word_ids USING (word) GROUP BY id)""",
}


def _sql(final: str, names: str = "", source: str = "prompts") -> str:
    """`final` behind the parts in `names`; the words tokens, subwords and packs stand for all their parts."""
    parts = []
    for name in names.split():
        if name == "tokens":
            parts += _token_parts(source).items()
        elif name == "subwords":
            parts += _SUBWORD_PARTS.items()
        elif name == "packs":
            parts += _PACK_PARTS.items()
        else:
            parts.append((name, _PARTS[name]))
    if not parts:
        return final
    listed = ",\n".join(f"{name} AS ({body})" for name, body in parts)
    recursive = "RECURSIVE " if {"subwords", "packs"} & set(names.split()) else ""
    return f"WITH {recursive}{listed}\n{final}"


_INSTRUCTIONS = "paired instructions"
_TOKENS = f"{_INSTRUCTIONS} prompts tokens"
_MANUAL = f"{_TOKENS} seq sequential manual labelled"
_GROUPED = f"{_TOKENS} lengths shuffled mega sorted_mega longest grouped"
_TRAINER = f"{_GROUPED} grouped_dealt trainer"
_DEALT = f"{_INSTRUCTIONS} seq dealt"
_RUN_CONFIGS = "runs base_values zero_values run_configs"


def _text(column: str) -> str:
    return f"array_to_string({column}, ' ') AS {column}"


_TRAIN_LOSS = """
        SELECT step, (SUM(n * -ln((pair_seen + 1) / CAST(prev_seen + (SELECT count(DISTINCT t) FROM (SELECT unnest(input_ids) AS t FROM tokens)) AS DOUBLE))) / SUM(n)) AS train_loss,
        CAST(SUM(n) AS BIGINT) AS scored_tokens
        FROM (
          SELECT c.step, c.n,
                 coalesce(SUM(c.n) OVER (PARTITION BY c.prev, c.next ORDER BY c.step
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pair_seen,
                 coalesce(p.prev_seen, 0) AS prev_seen
          FROM (SELECT batch_id AS step, prev, next, COUNT(*) AS n FROM pairs GROUP BY ALL) c
          JOIN (SELECT batch_id AS step, prev,
                       SUM(COUNT(*)) OVER (PARTITION BY prev ORDER BY batch_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_seen
                FROM pairs GROUP BY batch_id, prev) p
            ON c.step = p.step AND c.prev = p.prev)
        GROUP BY step"""

ORACLES: dict[str, str] = {
    "load_instructions": _sql("SELECT * FROM instructions WHERE split = 'train'", _INSTRUCTIONS),
    "cached_table": _sql("SELECT * FROM instructions", _INSTRUCTIONS),
    "content_cache": _sql(
        "SELECT *, 1 AS build FROM instructions WHERE split = 'train' UNION ALL SELECT *, 2 AS build FROM instructions", _INSTRUCTIONS
    ),
    "split_filter": _sql("SELECT * FROM instructions WHERE split = 'test'", _INSTRUCTIONS),
    "load_config": _sql(
        """SELECT run_id, key, value FROM runs CROSS JOIN base_values
        UNION ALL SELECT run_id, 'train_batch_size', 'auto' FROM runs
        UNION ALL SELECT run_id, 'zero_optimization', '{}' FROM runs""",
        "runs base_values",
    ),
    "file_manifest": _sql("SELECT lib, repo, name, target_path FROM manifest", "repo_files models manifest"),
    "list_files": _sql(
        """SELECT DISTINCT 'repo=' || repo || '/shard=' || CAST(length(name) % 4 AS VARCHAR) || '/' AS folder, true AS has_bytes
        FROM repo_files WHERE present""",
        "repo_files",
    ),
    "pending_files": _sql(
        """SELECT DISTINCT lib, repo, name, target_path FROM manifest
        WHERE target_path NOT IN (SELECT target_path FROM manifest WHERE present)""",
        "repo_files models manifest",
    ),
    "write_batches": _sql(
        f"SELECT rank, step, slot, id, {_text('input_ids')}, {_text('labels')} FROM trainer", _TRAINER
    ),
    "metrics_sink": _sql(
        "SELECT run_id, rank, epoch, step, global_step, key, value FROM metrics", "metrics"
    ),
    "metrics_upsert": _sql(
        """SELECT run_id, rank, epoch, step, global_step, key, CASE WHEN run_id % 2 = 0 THEN value ELSE -value END AS value
        FROM metrics""",
        "metrics",
    ),
    "params_sink": _sql(
        """SELECT run_id, 'hf' AS source, key, value
        FROM runs CROSS JOIN trainer_values WHERE rank = 0
        UNION ALL
        SELECT run_id, 'hf', 'deepspeed', '{' || string_agg('"' || key || '":' || value, ',' ORDER BY key) || '}'
        FROM run_configs WHERE rank = 0 GROUP BY run_id
        UNION ALL
        SELECT run_id, 'ds_' AS source, 'ds_' || key AS key, value FROM run_configs WHERE rank = 0""",
        f"{_RUN_CONFIGS} trainer_values",
    ),
    "prompt_template": _sql("SELECT id, text FROM prompts", f"{_INSTRUCTIONS} prompts"),
    "build_vocab": _sql("SELECT token, token_id FROM vocabulary", "doc_texts tokens", "doc_texts"),
    "build_vocab_bounded": _sql(
        "SELECT token, token_id FROM vocabulary WHERE token_id < 303", "doc_texts tokens", "doc_texts"
    ),
    "tokenize": _sql(
        "SELECT id, CAST(len(all_ids) AS INT) AS n_tokens, array_to_string(all_ids, ' ') AS input_ids FROM all_tokens",
        "doc_texts tokens",
        "doc_texts",
    ),
    "tokenize_joined": _sql(
        "SELECT id, CAST(len(all_ids) AS INT) AS n_tokens, array_to_string(all_ids, ' ') AS input_ids FROM all_tokens",
        "doc_texts tokens",
        "doc_texts",
    ),
    "truncate_tokens": _sql(
        f"SELECT id, n_tokens, {_text('input_ids')} FROM tokens", "doc_texts tokens", "doc_texts"
    ),
    "attention_mask": _sql(
        """SELECT id, array_to_string(list_transform(input_ids, lambda x: 1), ' ') AS attention_mask
        FROM tokens""",
        "doc_texts tokens",
        "doc_texts",
    ),
    "drop_columns": _sql(
        f"""SELECT t.id, i.split, {_text('input_ids')}, n_tokens
        FROM tokens t JOIN instructions i ON t.id = i.id""",
        _TOKENS,
    ),
    "keep_model_columns": _sql(
        f"""SELECT id, {_text('input_ids')},
        array_to_string(list_transform(input_ids, lambda x: 1), ' ') AS attention_mask FROM tokens""",
        _TOKENS,
    ),
    "sequential_batches": _sql(
        "SELECT id, seq, batch_id, slot FROM sequential", f"{_INSTRUCTIONS} seq sequential"
    ),
    "length_grouped_batches": _sql(
        "SELECT id, n_tokens, seq, seq // 4 AS batch_id, CAST(seq % 4 AS INT) AS slot FROM grouped",
        _GROUPED,
    ),
    "batch_max_length": _sql(
        """SELECT s.id, t.n_tokens, s.batch_id, s.slot,
        MAX(t.n_tokens) OVER (PARTITION BY s.batch_id) AS batch_length
        FROM sequential s JOIN tokens t ON s.id = t.id""",
        f"{_TOKENS} seq sequential",
    ),
    "pad_sequences": _sql(
        f"SELECT batch_id, slot, id, {_text('input_ids')}, {_text('attention_mask')} FROM manual", _MANUAL
    ),
    "causal_labels": _sql(f"SELECT batch_id, slot, id, {_text('labels')} FROM labelled", _MANUAL),
    "batch_stats": _sql(
        """SELECT seq // 4 AS batch_id, COUNT(*) AS rows, CAST(SUM(n_tokens) AS BIGINT) AS real_tokens,
        CAST(MAX(n_tokens) * COUNT(*) - SUM(n_tokens) AS BIGINT) AS pad_tokens
        FROM grouped GROUP BY seq // 4""",
        _GROUPED,
    ),
    "shard_replicated": _sql(
        """SELECT CAST(r AS INT) AS rank, batch_id AS step, slot, id
        FROM sequential CROSS JOIN range(4) AS ranks(r)""",
        f"{_INSTRUCTIONS} seq sequential",
    ),
    "shard_batches": _sql("SELECT rank, step, slot, id, batch_id FROM dealt", _DEALT),
    "micro_to_optimizer_step": _sql(
        "SELECT rank, step, slot, id, step // 2 AS optimizer_step FROM dealt", _DEALT
    ),
    "epoch_replay": _sql(
        """SELECT CAST(e AS INT) AS epoch, rank, step, slot, id
        FROM dealt CROSS JOIN range(2) AS epochs(e)""",
        _DEALT,
    ),
    "global_step": _sql(
        """SELECT CAST(e AS INT) AS epoch, rank, step, slot, id,
        e * (SELECT MAX(step) + 1 FROM dealt) + step AS global_step
        FROM dealt CROSS JOIN range(2) AS epochs(e)""",
        _DEALT,
    ),
    "training_batches": _sql(
        f"""SELECT rank, step, slot, id, {_text('input_ids')}, {_text('attention_mask')},
        {_text('labels')} FROM trainer""",
        _TRAINER,
    ),
    "trainer_epochs": _sql(
        f"SELECT CAST(epoch AS INT) AS epoch, rank, step, slot, id, {_text('input_ids')}, {_text('labels')} FROM epoch_trainer",
        f"{_TOKENS} lengths epoch_shuffled epoch_mega epoch_sorted epoch_grouped epoch_dealt epoch_trainer",
    ),
    "token_loss_mask": _sql(
        """SELECT l.batch_id, l.slot, l.id, CAST(COUNT(p.next) AS INT) AS n_scored,
        coalesce(string_agg(CAST(p.next AS VARCHAR), ' ' ORDER BY p.i), '') AS scored
        FROM labelled l LEFT JOIN pairs p ON l.id = p.id GROUP BY l.batch_id, l.slot, l.id""",
        f"{_MANUAL} pairs",
    ),
    "bigram_train_loss": _sql(
        f"SELECT step, round(train_loss, 6) AS train_loss, scored_tokens FROM ({_TRAIN_LOSS})", f"{_MANUAL} pairs"
    ),
    "logged_train_loss": _sql(
        f"""SELECT CAST(1 AS BIGINT) AS run_id, (step // 10 + 1) * 10 AS log_step, round(AVG(train_loss), 6) AS loss,
        COUNT(*) AS steps
        FROM ({_TRAIN_LOSS}) GROUP BY step // 10""",
        f"{_MANUAL} pairs",
    ),
    "lr_schedule": _sql(
        """SELECT run_id, global_step, round(0.0002 * least((global_step - 1) / 100.0, 1.0), 10) AS lr
        FROM metrics""".replace("0.0002", "CAST(0.0002 AS DOUBLE)").replace("100.0", "CAST(100 AS DOUBLE)"),
        "metrics",
    ),
    "lr_schedule_constant": _sql(
        "SELECT run_id, global_step, CAST(0.0002 AS DOUBLE) AS lr FROM metrics", "metrics"
    ),
    "step_plan": _sql(
        """SELECT run_id, gpus * nodes AS num_processes,
        (n + 3) // 4 AS manual_steps_per_epoch, (n + 3) // 4 * 2 AS manual_total_steps,
        greatest(((n + 3) // 4 + gpus * nodes - 1) // (gpus * nodes) // 2, 1) AS trainer_steps_per_epoch,
        greatest(((n + 3) // 4 + gpus * nodes - 1) // (gpus * nodes) // 2, 1) * 2 AS trainer_total_steps
        FROM runs CROSS JOIN (SELECT COUNT(*) AS n FROM instructions)""",
        f"{_INSTRUCTIONS} runs",
    ),
    "logged_loss": _sql(
        """SELECT run_id, ((global_step - 1) // 10 + 1) * 10 AS log_step, round(AVG(value), 6) AS loss,
        COUNT(*) AS steps
        FROM metrics WHERE key = 'purchase' GROUP BY run_id, (global_step - 1) // 10""",
        "metrics",
    ),
    "checkpoint_steps": _sql(
        """SELECT DISTINCT run_id, global_step,
        '/models/results/checkpoint-' || CAST(global_step AS VARCHAR) AS checkpoint
        FROM metrics WHERE global_step % 50 = 0""",
        "metrics",
    ),
    "prefix_config_keys": _sql(
        "SELECT run_id, 'ds_' || key AS key, value FROM run_configs", _RUN_CONFIGS
    ),
    "config_variants": _sql("SELECT run_id, stage, key, value FROM run_configs", _RUN_CONFIGS),
    "select_variant": _sql(
        """SELECT r.run_id, r.stage, CAST(json_extract_string(z.value, '$.stage') AS INT) AS zero_stage,
        json_extract_string(z.value, '$.reduce_bucket_size') AS reduce_bucket_size
        FROM runs r JOIN zero_values z ON r.stage = z.stage""",
        "runs zero_values",
    ),
    "offload_device": _sql(
        """SELECT r.run_id, json_extract_string(z.value, '$.offload_optimizer.device') AS device
        FROM runs r JOIN zero_values z ON r.stage = z.stage""",
        "runs zero_values",
    ),
    "optimizer_choice": _sql(
        """SELECT run_id, CASE WHEN stage = 'stage_3_offload' THEN 'DeepSpeedCPUAdam' ELSE 'FusedAdam' END
        AS optimizer FROM runs""",
        "runs",
    ),
    "run_name": _sql(
        """SELECT run_id, CASE WHEN rank = 0 THEN run_name
        ELSE run_name || '_rank_' || CAST(rank AS VARCHAR) END AS run_name FROM runs""",
        "runs",
    ),
    "layout": _sql(
        "SELECT run_id, gpus * nodes AS num_processes, nodes = 1 AS local FROM runs", "runs"
    ),
    "global_batch_size": _sql(
        "SELECT run_id, gpus * nodes * 4 AS global_batch_size, gpus * nodes * 4 AS in_config FROM runs", "runs"
    ),
    "parent_only_multinode": _sql(
        "SELECT run_id, CASE WHEN nodes > 1 THEN parent_run_id END AS parent_run_id FROM runs", "runs"
    ),
    "expand_runs": _sql(
        """SELECT run_id AS launch_id, CAST(r AS INT) AS rank,
        CASE WHEN r = 0 THEN run_name ELSE run_name || '_rank_' || CAST(r AS VARCHAR) END AS run_name,
        CASE WHEN nodes > 1 THEN parent_run_id END AS parent_run_id
        FROM runs, range(0, gpus * nodes) AS ranks(r)""",
        "runs",
    ),
    "run_tree": _sql(
        """SELECT c.run_id, c.rank, CASE WHEN c.nodes > 1 THEN c.parent_run_id END AS parent_run_id, p.run_name AS parent_name, p.rank AS parent_rank
        FROM runs c LEFT JOIN runs p ON c.nodes > 1 AND c.parent_run_id = p.run_id""",
        "runs",
    ),
    "rank0_metrics": _sql(
        "SELECT run_id, rank, key, value, global_step FROM metrics WHERE rank = 0", "metrics"
    ),
    "config_conflicts": _sql(
        """SELECT run_id, trainer_key, engine_key, trainer_value, engine_value FROM param_pairs
        WHERE trainer_value <> 'auto' AND engine_value <> 'auto'
          AND CASE WHEN TRY_CAST(trainer_value AS DOUBLE) IS NOT NULL AND TRY_CAST(engine_value AS DOUBLE) IS NOT NULL
                   THEN TRY_CAST(trainer_value AS DOUBLE) <> TRY_CAST(engine_value AS DOUBLE)
                   ELSE replace(lower(trainer_value), ' ', '') <> replace(lower(engine_value), ' ', '') END""",
        "runs key_pairs param_pairs",
    ),
    "config_leaves": _sql("SELECT run_id, key, value FROM leaves", f"{_RUN_CONFIGS} leaves"),
    "deep_conflicts": _sql(
        """SELECT run_id, key AS trainer_key, any_value(value) FILTER (side = 'other') AS trainer_value,
        any_value(value) FILTER (side = 'own') AS engine_value
        FROM (SELECT 'own' AS side, run_id, key, value FROM leaves
              UNION ALL
              SELECT 'other', runs.run_id, o.key, CASE WHEN o.key = 'train_batch_size' THEN 'auto' ELSE o.value END
              FROM runs, (SELECT DISTINCT ON (key) key, value FROM leaves WHERE stage = 'stage_3_offload') AS o)
        GROUP BY run_id, key
        HAVING coalesce(any_value(value) FILTER (side = 'other'), '') <> 'auto' AND coalesce(any_value(value) FILTER (side = 'own'), '') <> 'auto'
           AND any_value(value) FILTER (side = 'other') IS DISTINCT FROM any_value(value) FILTER (side = 'own')""",
        f"{_RUN_CONFIGS} leaves",
    ),
    "map_rows": _sql("SELECT id, context, nfc_normalize(response) AS composed FROM instructions", _INSTRUCTIONS),
    "subword_tokenize": _sql(
        f"SELECT id, n_tokens, {_text('input_ids')} FROM tokens", f"{_INSTRUCTIONS} prompts subwords"
    ),
    "subword_decode": _sql("SELECT id, text FROM prompts", f"{_INSTRUCTIONS} prompts"),
    "pluggable_tokenizer": _sql(
        f"""SELECT batch_id, slot, id, {_text('input_ids')},
        array_to_string(list_transform(input_ids, lambda x: CASE WHEN x = 50256 THEN -100 ELSE x END), ' ') AS labels
        FROM (SELECT batch_id, slot, t.id, list_resize(input_ids, MAX(n_tokens) OVER (PARTITION BY batch_id), 50256) AS input_ids
              FROM sequential s JOIN tokens t ON s.id = t.id)""",
        f"{_INSTRUCTIONS} prompts subwords seq sequential",
    ),
    "collate_batches": _sql(
        f"SELECT batch_id, slot, id, {_text('input_ids')}, {_text('labels')} FROM labelled", _MANUAL
    ),
    "pack_batches": _sql(
        """SELECT batch_id, pack, array_to_string(list_resize(flatten(packed), room, 2), ' ') AS input_ids,
        array_to_string(list_resize(flatten(list_transform(packed, lambda r, i: list_transform(r, lambda x: i - 1))), room, -1), ' ') AS segments
        FROM packs""",
        f"{_TOKENS} seq sequential packs",
    ),
    "run_on_ranks": _sql(
        """SELECT rank, COUNT(*) AS rows, MAX(step) + 1 AS steps, CAST(SUM(n_tokens) AS BIGINT) AS tokens
        FROM (SELECT CAST((v // 4) % 2 AS INT) AS rank, v // 8 AS step, t.n_tokens
              FROM (SELECT COUNT(*) AS n FROM seq),
                   range(0, ((n + 7) // 8) * 8) AS r(v)
              JOIN seq ON seq.seq = r.v % n JOIN tokens t ON t.id = seq.id)
        GROUP BY rank""",
        f"{_TOKENS} seq",
    ),
}
