"""The catalog's queries as SQL for another engine, by other methods where there are any."""

_SPLIT = """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5('42:'||doc_id)) AS rn,
  count(*) OVER (PARTITION BY quality) AS n FROM labels)
SELECT doc_id, quality, toxic,
  CASE WHEN rn <= greatest(1, least(floor(n::DOUBLE*0.5::DOUBLE)::BIGINT, n-1)) THEN 'train' ELSE 'test' END AS split
FROM r"""

_CHAT = "'<|im_start|>'||role||chr(10)||text||'<|im_end|>'||chr(10)"
_ASK = "'<|im_start|>assistant'||chr(10)"

ORACLE: dict[str, str] = {
    "s1_csv_scan": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "s1_csv_scan_typed": """
SELECT p_partkey, p_name, p_brand, p_type, p_size::BIGINT AS p_size, p_retailprice FROM part""",
    "s2_json_lines_layout": """
        SELECT p_partkey, 'size: ' || p_size || chr(10) || 'name: ' || p_name || chr(10) || 'Key: ' || p_partkey || chr(10) || 'price: '
               || CASE WHEN p_size % 2 = 0 THEN p_retailprice::VARCHAR ELSE p_size::VARCHAR END AS content FROM part""",
    "p1_rows_at_positions": """
        WITH numbered AS (
          SELECT o_orderkey, o_custkey, row_number() OVER () - 1 AS position, 'rows' AS kind FROM orders
          UNION ALL
          SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) - 1, 'lines' FROM orders)
        SELECT o_orderkey, o_custkey, position, kind FROM numbered WHERE position < 1500 AND position % 3 = 0""",
    "s3_workbook_scan": "SELECT p_partkey, p_name, p_brand, p_type, p_size::BIGINT AS p_size, p_retailprice FROM part",
    "s6_token_template": """
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY min(turn)) - 1 AS pos, role AS name,
               arg_max(text, turn) AS token FROM conversations GROUP BY conv_id, role""",
    "s2_json_lines_scan": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "k1_csv_sink": """
SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
  o_totalprice::VARCHAR AS o_totalprice, o_orderdate::VARCHAR AS o_orderdate, o_orderpriority FROM orders""",
    "k2_split_sink": _SPLIT,
    "k2_named_split_sink": _SPLIT,
    "p1_row_at": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 1 OFFSET 7",
    "p1_row_at_file_position": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 1 OFFSET 7",
    "p3_cast_string": """
SELECT o_orderkey::VARCHAR AS o_orderkey, o_totalprice::VARCHAR AS o_totalprice FROM orders""",
    "p4_label_int": """
SELECT doc_id, CASE quality WHEN 1 THEN true WHEN 0 THEN false END AS label FROM labels""",
    "p4_label_string": """
SELECT o_orderkey, CASE lower(trim(o_orderstatus)) WHEN 'f' THEN true WHEN 'o' THEN false END AS label FROM orders""",
    "p4_label_double": """
SELECT event_id, CASE WHEN trunc(value) BETWEEN 0 AND 9 THEN true WHEN trunc(value) BETWEEN 10 AND 19 THEN false END
  AS label FROM events""",
    "p6_class_filter": "SELECT doc_id FROM labels WHERE quality = 1",
    "p7_label_text": """
SELECT o_orderkey, nullif(trim(coalesce(nullif(o_orderstatus,'P'),'')),'') AS label_text FROM orders""",
    "a1_unknown_audit": """
SELECT event_type AS value, count(*) AS n FROM events
WHERE event_type NOT IN ('purchase','signup','view','click') GROUP BY 1""",
    "a2_class_counts": "SELECT l_linestatus='F' AS label, count(*) AS n FROM lineitem GROUP BY 1",
    "a3_split_sizes": """
WITH r AS (SELECT l_linestatus='F' AS label, count(*) AS n FROM lineitem GROUP BY 1),
k AS (SELECT *, greatest(1, least(floor(n::DOUBLE*0.8::DOUBLE)::BIGINT, n-1)) AS k FROM r)
SELECT 'train' AS split, sum(k)::BIGINT AS n FROM k UNION ALL SELECT 'test', sum(n-k)::BIGINT FROM k""",
    "x1_ratio_split": """
WITH h AS (SELECT *, l_linestatus='F' AS label,
  md5('42:'||l_orderkey||':'||l_partkey||':'||l_suppkey||':'||l_linenumber) AS h FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h) AS rn, count(*) OVER (PARTITION BY label) AS n FROM h)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, label,
  CASE WHEN rn <= greatest(1, least(floor(n::DOUBLE*0.8::DOUBLE)::BIGINT, n-1)) THEN 'train' ELSE 'test' END AS split
FROM r""",
    "x1_ratio_split_shared_keys": """
WITH r AS (SELECT l_linestatus='F' AS label, count(*) AS n FROM lineitem GROUP BY 1),
k AS (SELECT *, greatest(1, least(floor(n::DOUBLE*0.8::DOUBLE)::BIGINT, n-1)) AS k FROM r)
SELECT label, 'train' AS split, k AS n FROM k UNION ALL SELECT label, 'test', n-k FROM k""",
    "x2_count_split": """
WITH r AS (SELECT doc_id, quality=1 AS label,
  row_number() OVER (PARTITION BY quality ORDER BY md5('42:'||doc_id), doc_id) AS rn FROM labels),
c AS (SELECT *, CASE WHEN label THEN 8 ELSE 3 END AS te, CASE WHEN label THEN 20 ELSE 5 END AS tr FROM r)
SELECT doc_id, label, CASE WHEN rn <= te THEN 'test' ELSE 'train' END AS split FROM c WHERE rn <= te+tr""",
    "x3_sample_n": "SELECT o_orderkey FROM orders ORDER BY md5('42:'||o_orderkey), o_orderkey LIMIT 500",
    "x4_complement": """
SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN
  (SELECT o_orderkey FROM orders ORDER BY md5('42:'||o_orderkey), o_orderkey LIMIT 500)""",
    "x5_union_of_classes": """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus='F'
UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus='O'""",
    "x6_shuffle": "SELECT user_id, event_id FROM events ORDER BY md5('7:'||event_id), event_id",
    "t1_safe_str": """
SELECT event_id, user_id::VARCHAR AS user_id, value::VARCHAR AS value, coalesce(props,'') AS props FROM events""",
    "t2_text_column": "SELECT doc_id, coalesce(text,'') AS content FROM documents",
    "t3_template": """
SELECT p_partkey, 'Part '||p_name||' {'||p_brand||'} size '||p_size||' costs '||p_retailprice AS content FROM part""",
    "t3_template_widths": """
SELECT p_partkey, '['||rpad(substr(p_name,1,10),20,' ')||'|'||lpad(p_size::VARCHAR,6,'*')||'|'
  ||repeat(' ',((12-length(p_brand))//2)::INT)||p_brand||repeat(' ',(12-length(p_brand)-(12-length(p_brand))//2)::INT)
  ||']' AS content FROM part""",
    "t4_article_comment": """
SELECT doc_id, 'Article:'||chr(10)||text||chr(10)||chr(10)||'Comment:'||chr(10)||source AS content FROM documents""",
    "t5_key_value": """
SELECT s_suppkey, 's_suppkey: '||s_suppkey||chr(10)||'s_name: '||s_name||chr(10)||'s_nationkey: '||s_nationkey
  ||chr(10)||'s_acctbal: '||s_acctbal AS content FROM supplier""",
    "t6_layout_choice": """
SELECT doc_id, 'Article:'||chr(10)||text||chr(10)||chr(10)||'Comment:'||chr(10)||source AS content FROM documents""",
    "t7_trim_lower": "SELECT o_orderkey, lower(o_orderpriority) AS word FROM orders",
    "t8_strip_tokens": """
SELECT doc_id, replace(replace(replace(text,'***',''),'###',''),'%%%','') AS content FROM documents""",
    "t9_preview": "SELECT doc_id, substr(text,1,500) AS preview, length(text)::BIGINT AS n FROM documents",
    "m1_messages": """
SELECT doc_id, 0 AS pos, 'system' AS role, 'Judge the text.' AS content FROM documents
UNION ALL SELECT doc_id, 1, 'user', text FROM documents""",
    "m2_validate": """
SELECT conv_id, count(*) FILTER (WHERE role='system')::BIGINT AS n_bad, min(turn) FILTER (WHERE role='system') AS first_bad
FROM conversations GROUP BY 1""",
    "m2_validate_lists": """
SELECT doc_id, false AS empty, CASE WHEN lang='en' THEN 1 ELSE 0 END::BIGINT AS n_bad,
  CASE WHEN lang='en' THEN 1 END AS first_bad FROM documents""",
    "m3_prompt": f"""
SELECT conv_id, string_agg({_CHAT},'' ORDER BY turn)||{_ASK} AS prompt FROM conversations GROUP BY 1""",
    "m3_prompt_blocks": f"""
SELECT conv_id, (turn//3)::BIGINT AS block, string_agg({_CHAT},'' ORDER BY turn) AS text FROM conversations GROUP BY 1, 2""",
    "m3_prompt_from_list": f"""
SELECT doc_id, '<|im_start|>system'||chr(10)||'Judge the text.<|im_end|>'||chr(10)||'<|im_start|>user'||chr(10)||text
  ||'<|im_end|>'||chr(10)||{_ASK}||'<think></think>' AS prompt FROM documents""",
    "m3_checked_lists": f"""
SELECT doc_id, nullif(trim(lang), '') AS label_text, '<|im_start|>system'||chr(10)||'Judge the text.<|im_end|>'||chr(10)||'<|im_start|>user'||chr(10)||text
  ||'<|im_end|>'||chr(10)||{_ASK} AS prompt FROM documents""",
    "v3_whole_run_tokens": f"""
WITH p AS (SELECT p_partkey, p_size::VARCHAR AS label_text,
  right('<|im_start|>assistant'||chr(10)||reverse(p_size::VARCHAR)||reverse(p_partkey::VARCHAR), 9) AS tail FROM part),
t(token, token_id) AS (VALUES ('1', 49::BIGINT), ('</s>', 2::BIGINT), ('t', NULL))
SELECT p_partkey, label_text, '<s>'||tail||'</s>' AS raw_text, tail AS generated_text,
  CASE WHEN contains(tail,'11') AND contains(tail,'22') THEN 'MULTIPLE' WHEN contains(tail,'11') THEN '11'
       WHEN contains(tail,'22') THEN '22' ELSE 'NONE' END AS extracted_label,
  token, contains('<s>'||tail||'</s>', token) AS found_in_text,
  coalesce(list_contains(list_transform(string_split(tail,''), lambda c: ascii(c)), token_id), false) AS found_in_ids, token_id
FROM p, t""",
    "m4_toggle": f"""
SELECT doc_id, {_ASK}||CASE lang WHEN 'en' THEN '<think>' WHEN 'fr' THEN '<think></think>' ELSE '' END AS suffix
FROM documents""",
    "g1_generate": """
SELECT doc_id, CASE WHEN contains(text,'the') THEN '<YES>' ELSE '<NO>' END AS generated_text FROM documents""",
    "g2_first_candidate": """
SELECT doc_id, coalesce(list_filter(string_split(text,chr(10)), lambda x: contains(x,'the'))[1],'') AS generated_text
FROM documents""",
    "g3_allowed_choice": """
SELECT vec_id, CASE WHEN embedding[4]>=embedding[8] AND embedding[4]>=embedding[12] THEN 3
  WHEN embedding[8]>=embedding[12] THEN 7 ELSE 11 END AS choice FROM embeddings""",
    "v1_extract_label": """
WITH m AS (SELECT conv_id, turn, list_filter(['the','The','ion'], lambda t: contains(text,t)) AS m
  FROM conversations WHERE role='assistant')
SELECT conv_id, turn, len(m)>0 AS has_special_token, array_to_string(m,',') AS matched_tokens,
  CASE len(m) WHEN 0 THEN 'NONE' WHEN 1 THEN m[1] ELSE 'MULTIPLE' END AS extracted_label FROM m""",
    "v2_token_check": """
SELECT c.conv_id, c.turn, t.token, contains(c.text,t.token) AS found_in_text,
  coalesce(list_contains(list_transform(string_split(c.text,' '), lambda x: length(x)::INT), t.id), false) AS found_in_ids,
  t.id::BIGINT AS token_id FROM conversations c, (VALUES ('the',3),('ion',9),('zz',NULL)) t(token,id)""",
    "v3_result_row": """
SELECT d.doc_id, l.quality::VARCHAR AS label_text, CASE WHEN contains(text,'the') THEN '<YES>' ELSE '<NO>' END
  AS extracted_label FROM documents d JOIN labels l USING (doc_id)""",
    "v3_whole_run": """
WITH p AS (SELECT p_partkey, p_size::VARCHAR AS label_text,
  'system Is it small? user assistant '||p_name||' in '||p_type AS prompt FROM part)
SELECT p_partkey, label_text, CASE WHEN contains(prompt,'the') THEN '<YES>' ELSE '<NO>' END AS generated_text,
  CASE WHEN contains(prompt,'the') THEN '<YES>' ELSE '<NO>' END AS extracted_label FROM p""",
    "e1_lookup": """
SELECT t.token, v.vec_id AS token_id, v.vec_id IS NOT NULL AS in_vocab
FROM (VALUES ('t5'),('t499'),('<A>')) t(token) LEFT JOIN embeddings v ON t.token = 't'||v.vec_id""",
    "e1_lookup_table": """
SELECT 't'||e.user_id AS token, v.vec_id AS token_id, v.vec_id IS NOT NULL AS in_vocab, count(*) AS n
FROM events e LEFT JOIN embeddings v ON e.user_id = v.vec_id GROUP BY ALL""",
    "e2_ordered_union": "SELECT event_type AS token, min(event_id)::BIGINT AS pos FROM events GROUP BY 1",
    "e2_ordered_union_of_two": """
SELECT token, min(pos)::BIGINT AS pos FROM (SELECT event_type AS token, event_id AS pos FROM events
  UNION ALL SELECT p_type, p_partkey + (SELECT max(event_id)+1 FROM events) FROM part) GROUP BY 1""",
    "e3_append": """
SELECT 't'||vec_id AS token, vec_id AS id FROM embeddings UNION ALL SELECT '<A>', max(vec_id)+1 FROM embeddings
UNION ALL SELECT '<B>', max(vec_id)+2 FROM embeddings""",
    "e3_append_table": """
SELECT 't'||vec_id AS token, vec_id AS id FROM embeddings
UNION ALL SELECT p_name, (SELECT max(vec_id) FROM embeddings) + row_number() OVER (ORDER BY pos)
FROM (SELECT p_name, min(p_partkey) AS pos FROM part GROUP BY 1)""",
    "e4_alignment": """
WITH s AS (SELECT (SELECT count(*) FROM embeddings) AS m, (SELECT count(*) FROM part) AS v)
SELECT 'bad_token_id' AS "check", 'error' AS severity, 'p'||p_partkey AS token, p_partkey AS id FROM part, s WHERE p_partkey >= m
UNION ALL SELECT 'bad_token_id', 'error', '<A>', NULL
UNION ALL SELECT 'vocab_larger', 'error', NULL, NULL FROM s WHERE v > m
UNION ALL SELECT 'sizes_differ', 'warning', NULL, NULL FROM s WHERE v <> m""",
    "e5_grow": """
SELECT vec_id, embedding[1]::DOUBLE AS first_value FROM embeddings
UNION ALL SELECT x, NULL FROM range((SELECT max(vec_id)+1 FROM embeddings), (SELECT count(*) FROM part)) r(x)""",
    "e6_extend": """
WITH g AS (SELECT vec_id, embedding FROM embeddings UNION ALL
  SELECT (SELECT max(vec_id) FROM embeddings)+k, embedding FROM embeddings, (VALUES (1),(2)) x(k) WHERE vec_id=0)
SELECT vec_id, unnest(range(64))::INT AS dim, unnest(embedding)::DOUBLE AS value FROM g""",
}
