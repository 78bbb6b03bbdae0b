"""The registered queries of the training-data operators: thin derivations of their contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ctw, licenses, lines, manifest, minhash, mixing, packing, phrases, quality, secrets, simhash, toxicity, vectors
from .common import fold_of, read_table, word_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return deco


@query("op1_embedding_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all embeddings at a cosine of 0.9 or more, found by product quantisation."""
    return vectors.near_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def tokenizer_file() -> str:
    """The public byte-level BPE file; its place is a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op2_best_fit_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_file())


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents; labels of the rows with crc32 mod 5 = 0 are held out."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    net = toxicity.train(docs, labels.where(fold_of("doc_id", 5) != 0), "toxic")
    return toxicity.score(docs.select("doc_id", "text"), net).select(
        "doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents: 3-word shingles, links at 3 or fewer differing bits."""
    return simhash.simhash_classes(read_table(spark, sf_dir, "documents"))


@query("op8_lm_scoring")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context-tree-weighting and add-one unigram scores; rows with crc32 mod 7 = 2 are held out."""
    held = fold_of("doc_id", 7) == 2
    scored = ctw.score_texts(read_table(spark, sf_dir, "documents").select("doc_id", "text"), ~held)
    return scored.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


@query("op9_secret_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and spans of the secrets in every document."""
    found = secrets.scan_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("secret_spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(secrets.span_text("secret_spans", secrets.KINDS[:3]).cast("binary"), 256).alias("base_sha256"),
                        secrets.span_text("secret_spans").alias("spans"))


@query("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents; labels of the rows with crc32 mod 3 = 1 are held out."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    weights = quality.train(docs, labels.where(fold_of("doc_id", 3) != 1), "quality")
    return quality.score(docs.select("doc_id", "text"), weights).select(
        "doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op5_substring_dedup", r"""
with m as (select doc_id, string_split(regexp_replace(text, '([.!?]+[\x20\x09-\x0D]+|\n)', '\1' || chr(1), 'g'), chr(1)) as parts
           from documents where text is not null),
u as (select doc_id, unnest(parts) as unit, generate_subscripts(parts, 1) as nth from m),
p as (select doc_id, unit,
             coalesce(sum(length(unit)) over (partition by doc_id order by nth rows between unbounded preceding and 1 preceding), 0) as start from u),
n as (select doc_id, start, start + length(unit) as stop,
             trim(regexp_replace(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') as norm
      from p),
f as (select doc_id, start, stop, first_value(doc_id) over w as kept_doc_id, first_value(start) over w as kept_start, row_number() over w as nth
      from n where len(string_split(norm, ' ')) >= 6 window w as (partition by norm order by doc_id, start))
select doc_id, cast(start as bigint) as start, cast(stop as bigint) as stop, kept_doc_id, cast(kept_start as bigint) as kept_start
from f where nth > 1
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line, cut at sentence ends, of six words or more that repeats an earlier one, with original offsets."""
    found = lines.repeated_units(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "sentence")
    return found.select(F.col("id").alias("doc_id"), "start", F.col("end").alias("stop"), F.col("kept_id").alias("kept_doc_id"), "kept_start")


@query("op5_whole_unit_dedup", r"""
with m as (select doc_id, 'paragraph' as unit, 1 as least, string_split(regexp_replace(text, '(\n(?:[\x20\x09\x0B-\x0D]*\n)+)', '\1' || chr(1), 'g'), chr(1)) as parts
           from documents where text is not null
           union all
           select doc_id, 'line', 1, string_split(regexp_replace(text, '(\n)', '\1' || chr(1), 'g'), chr(1)) from documents where text is not null
           union all
           select doc_id, 'sentence', 6, string_split(regexp_replace(text, '([.!?]+[\x20\x09-\x0D]+|\n)', '\1' || chr(1), 'g'), chr(1))
           from documents where text is not null),
u as (select doc_id, unit, least, unnest(parts) as part, generate_subscripts(parts, 1) as nth from m),
p as (select doc_id, unit, least, part, coalesce(sum(length(part)) over
             (partition by doc_id, unit order by nth rows between unbounded preceding and 1 preceding), 0) as start from u),
n as (select doc_id, unit, least, start, start + length(part) as stop,
             trim(regexp_replace(translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') as norm
      from p),
f as (select doc_id, unit, start, stop, first_value(doc_id) over w as kept_doc_id, first_value(start) over w as kept_start, row_number() over w as nth
      from n where norm <> '' and len(string_split(norm, ' ')) >= least window w as (partition by unit, norm order by doc_id, start))
select doc_id, unit, cast(start as bigint) as start, cast(stop as bigint) as stop, kept_doc_id, cast(kept_start as bigint) as kept_start
from f where nth > 1
""")
def op5_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole paragraph and line, and every sentence of six words or more, that repeats an earlier one."""
    found = lines.repeated_units(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "all")
    return found.select(F.col("id").alias("doc_id"), "unit", "start", F.col("end").alias("stop"), F.col("kept_id").alias("kept_doc_id"), "kept_start")


@query("op6_document_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-permutation MinHash of every document and of its edited text."""
    return minhash.edited_fingerprints(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_source_mixing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of 150 % of all words takes of every document, sources weighing 3, 1, 2 in turn."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed, sizes, quotas = mixing.mix(docs, F.array("source"), word_count(F.col("text")), mixing.rotating_quotas)
    rows = [(s, n, float(quotas[s])) for s, n in sizes.items()]
    # One row per source; mix() bounds their number.
    per_source = F.broadcast(spark.createDataFrame(rows, "name string, source_size long, target double"))
    return mixed.join(per_source, F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", F.col("mix_size").alias("size"), "source_size", "target", F.col("mix_taken").alias("taken"))


@query("op11_phrase_collocations", r"""
with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
q as (select row_number() over () as piece_id, lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as ws from p),
x as (select piece_id, lang, unnest(ws) as w1, generate_subscripts(ws, 1) as i from q),
g as (select lang, w1, lead(w1, 1) over w as w2, lead(w1, 2) over w as w3, lead(w1, 3) over w as w4
      from x window w as (partition by piece_id order by i)),
f as (select lang, [w1] as ws, count(*) as c from g group by all
      union all select lang, [w1, w2], count(*) from g where w2 is not null group by all
      union all select lang, [w1, w2, w3], count(*) from g where w3 is not null group by all
      union all select lang, [w1, w2, w3, w4], count(*) from g where w4 is not null group by all),
t as (select lang, sum(c) as n from f where len(ws) = 1 group by lang),
k as (select lang, ws, c from f where c >= 30),
cuts as (select lang, ws, c as a, unnest(range(1, len(ws))) as k from k where len(ws) > 1),
scored as (select u.lang, u.ws, u.a, u.k, l.c as l, r.c as r, cast(floor(2000000::hugeint * u.a // (l.c + r.c)) as bigint) as score
           from cuts u join k l on l.lang = u.lang and l.ws = u.ws[1:u.k] join k r on r.lang = u.lang and r.ws = u.ws[u.k + 1:]),
best as (select * from scored qualify row_number() over (partition by lang, ws order by score, k) = 1),
inner1 as (select lang, c, ws, unnest(range(2, len(ws))) as size from k where len(ws) > 2),
inner2 as (select lang, c, ws, size, unnest(range(1, len(ws) - size + 2)) as pos from inner1),
longer as (select lang, ws[pos:pos + size - 1] as ws, max(c) as c from inner2 group by all),
kept as (select b.*, array_to_string(b.ws, ' ') as phrase from best b left join longer o on o.lang = b.lang and o.ws = b.ws
         where o.c is null or 100::hugeint * o.c < 80::hugeint * b.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, cast(t.n as bigint) as n, score from ranked join t using (lang) where rank <= 2000
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 most cohesive phrases of each language, counted by HAT-tries."""
    return phrases.collocations(read_table(spark, sf_dir, "documents").select("lang", "text"))


@query("op12_merkle_manifest", r"""
with recursive field as (
  select row_number() over () as rid, doc_id, source, text,
         [cast(doc_id as varchar), source, lang, cast(n_chars as varchar)] as fields,
         xor(list_reduce(flatten(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: list_transform(range(8), lambda b: (ascii(c) >> b) & 1))),
             lambda a, b: case when (xor(a, b) & 1) = 1 then xor(a >> 1, 3988292384) else a >> 1 end, 4294967295), 4294967295) % 2 = 0 as tamper
  from documents),
prefix as (
  select *, list_reduce(list_transform(fields, lambda f: coalesce(octet_length(encode(f)) || ':' || f, '-')), lambda a, b: a || b) as head from field),
leaves as (
  select rid, doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) as leaf,
         case when tamper then sha256(head || coalesce(octet_length(encode(replace(text, chr(10), ''))) || ':' || replace(text, chr(10), ''), '-')) end as other
  from prefix),
placed as (select *, row_number() over (partition by source order by doc_id nulls first, leaf, rid) - 1 as i from leaves),
nodes as (
  select 0 as level, source, i, leaf as digest from placed
  union all
  select level + 1, source, i // 3, sha256(string_agg(digest, '' order by i))
  from (select *, count(*) over (partition by source) as n from nodes) where n > 1 group by level, source, i // 3),
heights as (select source, max(level) as height from nodes group by source),
subroots as (select n.source, n.digest as subroot, row_number() over (order by encode(n.source) nulls first) - 1 as i
             from nodes n join heights h on n.source is not distinct from h.source and n.level = h.height),
tops as (
  select 0 as level, i, subroot as digest from subroots
  union all
  select level + 1, i // 3, sha256(string_agg(digest, '' order by i))
  from (select *, count(*) over () as n from tops) where n > 1 group by level, i // 3),
crown as (select max(level) as height, max_by(digest, level) as root from tops),
up as (
  select rid, source, 0 as level, i, '' as proof, coalesce(other, leaf) as folded from placed
  union all
  select u.rid, u.source, u.level + 1, u.i // 3, u.proof || coalesce(string_agg(n.digest, '' order by n.i) filter (n.i <> u.i), ''),
         sha256(string_agg(case when n.i = u.i then u.folded else n.digest end, '' order by n.i))
  from up u join heights h on u.source is not distinct from h.source and u.level < h.height
  join nodes n on n.source is not distinct from u.source and n.level = u.level and n.i // 3 = u.i // 3
  group by u.rid, u.source, u.level, u.i, u.proof, u.folded),
sides as (select u.rid, s.i, s.subroot, u.proof, u.folded from up u join heights h on u.source is not distinct from h.source and u.level = h.height
          join subroots s on s.source is not distinct from u.source),
rise as (
  select rid, 0 as level, i, proof, folded from sides
  union all
  select u.rid, u.level + 1, u.i // 3, u.proof || coalesce(string_agg(n.digest, '' order by n.i) filter (n.i <> u.i), ''),
         sha256(string_agg(case when n.i = u.i then u.folded else n.digest end, '' order by n.i))
  from rise u join crown c on u.level < c.height join tops n on n.level = u.level and n.i // 3 = u.i // 3
  group by u.rid, u.level, u.i, u.proof, u.folded)
select p.doc_id, p.leaf, s.subroot, c.root, sha256(r.proof) as proof_sha256, r.folded as folded_root, r.folded = c.root as verified
from placed p join sides s using (rid) cross join crown c join rise r on r.rid = p.rid and r.level = c.height
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subtree root, root and proof of every document, and whether its tampered form still verifies."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return manifest.verify(docs, {"text": tampered}).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query("op13_license_scan")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, labels and score of every whole document."""
    found = licenses.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions")
