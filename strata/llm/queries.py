"""One query per operator, over whole tables, with production parameters, and DuckDB SQL where it can say the same.

The tables hold no dated lists and no archive records; both are derived from all of ``pages`` by Spark: digits of a host's md5 decide
which list entries it gets and when, those of a page's id which records follow its first response."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.llm import (bpe, caps, chat, classifier, fill_in_middle, mixing, repetition, revisits, simhash, spelling, suffixes, token_files,
                        url_filters)
from strata.llm.mixing import digits
from strata.session import scratch_dir

#: Words are runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
FIRST_DAY = "2024-01-01"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path() -> str:
    """Default of the tokenizer parameter: a file of the installed public vocabularies."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def day(plus: Column) -> Column:
    return F.date_add(F.to_date(F.lit(FIRST_DAY)), plus.cast("int"))


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), words_per_shingle=3, max_bits=2)


def op2_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir).select("doc_id", "text"), tokenizer_path())


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token_files")
    manifest = token_files.write(documents(spark, sf_dir), tokenizer_path(), folder, end_id=2)
    return token_files.read(spark, manifest, folder)


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries derived from the hosts of all pages."""
    hosts = pages.select(url_filters.host(F.col("url")).alias("h")).where("h is not null").distinct()
    parents = hosts.select(F.substring_index("h", ".", -3).alias("h")).distinct()
    h = F.col("h")
    begin = digits(h, 2, 2)
    end = begin + 20 + digits(h, 5, 2) % 120

    def rows(of, wanted, name, pattern, action, at):
        return of.where(wanted).select(F.lit(name).alias("list"), pattern.alias("pattern"), F.lit(action).alias("action"), day(at).alias("at"))

    listed = digits(h, 1, 1) < 6
    return (rows(hosts, listed, "block", h, "add", begin)
            .union(rows(hosts, listed & (digits(h, 4, 1) < 8), "block", h, "remove", end))
            .union(rows(hosts, listed & (digits(h, 4, 1) < 4), "block", h, "add", end + 30))
            .union(rows(hosts, digits(h, 7, 1) < 5, "allow", F.concat(h, F.lit("/en")), "add", digits(h, 8, 2)))
            .union(rows(parents, digits(h, 1, 1) < 4, "block", h, "add", begin)))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    captures = pages.withColumn("fetched", day(F.pmod(F.col("page_id") * 37, F.lit(360))))
    return url_filters.evaluate(captures, list_entries(pages))


def op5_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.rules(documents(spark, sf_dir).select("doc_id", "text"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the text that is left, which tells what is kept."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return suffixes.remove_repeats(docs, length=400).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many tokens (words) as there are, no source more than twice."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return mixing.mix(docs, words(F.col("text")), max_epochs=2.0, budget=1.0).drop("text")


def archive_records(pages: DataFrame) -> DataFrame:
    """Four records per page: a response, a revisit, a second response or revisit, and a revisit."""
    page = F.col("page_id").cast("string")
    d = lambda k: digits(page, k, 1)
    first = F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 12), F.lit('"'))
    second = F.concat(F.lit('"2-'), F.substring(F.md5("html"), 13, 12), F.lit('"'))
    base = pages.select("page_id", "url", first.alias("e1"), second.alias("e2"), F.md5("html").alias("m"), F.length("html").alias("n"),
                        F.pmod(F.col("page_id") * 37, F.lit(200)).alias("start"), d(1).alias("d1"), d(2).alias("d2"), d(3).alias("d3"))
    k = F.col("k")
    rows = base.select("*", F.explode(F.array(*[F.lit(x) for x in range(4)])).alias("k"))
    full = (k == 0) | ((k == 2) & (F.col("d2") < 8))
    known = F.when((k == 3) & (F.col("d2") < 8), F.col("e2")).otherwise(F.col("e1"))
    tag = (F.when(full, F.when(k == 0, F.col("e1")).otherwise(F.col("e2")))
           .when(F.col("d1") < 3, F.concat(F.lit("W/"), known)).when(F.col("d1") < 5, F.lit('"other"')).when(F.col("d1") < 8, None).otherwise(known))
    modified = F.when(full, F.concat(F.lit("v"), k.cast("string"))).when(F.col("d3") < 8, F.when((k == 3) & (F.col("d2") < 8), F.lit("v2")).otherwise(F.lit("v0")))
    at = day(F.col("start") + k * 25 + F.col("d3"))
    head = F.map_filter(F.create_map(
        F.lit("cache-control"), F.concat(F.lit("max-age="), (k * 60).cast("string")), F.lit("content-length"), F.when(full, F.col("n").cast("string")).otherwise("0"),
        F.lit("content-type"), F.when(full, F.lit("text/html")), F.lit("date"), at.cast("string"), F.lit("etag"), tag,
        F.lit("set-cookie"), F.when(~full, F.lit("s=1"))), lambda _, v: v.isNotNull())
    return rows.select((F.col("page_id") * 4 + k).alias("record_id"), "url", at.alias("at"), F.when(full, "response").otherwise("revisit").alias("kind"),
                       tag.alias("etag"), modified.alias("last_modified"), head.alias("headers"),
                       F.when(full, F.when(k == 0, F.col("m")).otherwise(F.md5(F.concat(F.col("m"), F.lit("2"))))).alias("digest"))


def op8_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive_records(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    done = revisits.resolve(records)
    pairs = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return done.select("record_id", "at", "kind", "status", "refers_to", "digest", F.array_join(pairs, ";").alias("headers"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out)
    scored = classifier.score(docs, classifier.train(docs, labels))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least_cosine=0.93)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(documents(spark, sf_dir).select("doc_id", "text"))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir).select("doc_id", "text"))


#: A conversation that is nothing but control strings.
ODD_TURN = "</s>[INST] ok [/INST]"


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select((F.lit(0) - 1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ODD_TURN).alias("text"))
    return chat.read_back(chat.formatted(turns.unionByName(odd)))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_bpe_roundtrip, op3_token_files, op4_url_filters, op5_repetition, op6_suffix_dedup,
                                   op7_mixing, op8_revisits, op9_quality, op10_caps, op11_fill_in_middle, op12_spelling, op13_chat)}

_DIGITS = "('0x' || substr(md5({0}), {1}, {2}))::BIGINT"


def _d(of: str, begin: int, count: int) -> str:
    return _DIGITS.format(of, begin, count)


_BEGIN = _d("h", 2, 2)
_END = f"{_BEGIN} + 20 + {_d('h', 5, 2)} % 120"
_DAY = "DATE '2024-01-01' + ({0})::INT"

#: DuckDB SQL of the operators that SQL can express.
ORACLE: dict[str, str] = {
    "op4_url_filters": rf"""
WITH captures AS (SELECT page_id, url, {_DAY.format("(page_id * 37) % 360")} AS fetched,
    nullif(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
    list_filter(string_split(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS steps FROM pages),
hosts AS (SELECT DISTINCT host AS h FROM captures WHERE host IS NOT NULL),
parents AS (SELECT DISTINCT array_to_string(string_split(h, '.')[-3:], '.') AS h FROM hosts),
entries AS (
    SELECT 'block' AS list, h AS pattern, 'add' AS action, {_DAY.format(_BEGIN)} AS at FROM hosts WHERE {_d('h', 1, 1)} < 6
    UNION ALL SELECT 'block', h, 'remove', {_DAY.format(_END)} FROM hosts WHERE {_d('h', 1, 1)} < 6 AND {_d('h', 4, 1)} < 8
    UNION ALL SELECT 'block', h, 'add', {_DAY.format(_END + ' + 30')} FROM hosts WHERE {_d('h', 1, 1)} < 6 AND {_d('h', 4, 1)} < 4
    UNION ALL SELECT 'allow', h || '/en', 'add', {_DAY.format(_d('h', 8, 2))} FROM hosts WHERE {_d('h', 7, 1)} < 5
    UNION ALL SELECT 'block', h, 'add', {_DAY.format(_BEGIN)} FROM parents WHERE {_d('h', 1, 1)} < 4),
asked AS (SELECT DISTINCT page_id, url, fetched, unnest(list_distinct(
    list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.'))
    || list_transform(range(1, len(steps) + 1), lambda i: host || '/' || array_to_string(steps[1:i], '/')))) AS asked
    FROM captures WHERE host IS NOT NULL),
-- as of the fetch: the last entry of each list and pattern up to that day
state AS (SELECT a.page_id, a.url, a.fetched, e.list, e.pattern, max(e.at) AS last_at FROM asked a JOIN entries e
    ON e.pattern = a.asked AND e.at <= a.fetched GROUP BY ALL),
active AS (SELECT s.* FROM state s WHERE (SELECT max(action) FROM entries e WHERE e.list = s.list AND e.pattern = s.pattern AND e.at = s.last_at) = 'add'),
ranked AS (SELECT *, count(*) OVER w AS n, row_number() OVER (w ORDER BY length(pattern) DESC, list = 'block' DESC, pattern DESC, list DESC) AS k
    FROM active WINDOW w AS (PARTITION BY page_id, url, fetched))
SELECT c.page_id, c.url, c.fetched, coalesce(r.n, 0) AS n_active, r.pattern AS decided_by, r.list AS decided_list,
    coalesce(r.list = 'block', false) AS blocked
FROM captures c LEFT JOIN ranked r ON r.page_id = c.page_id AND r.url = c.url AND r.fetched = c.fetched AND r.k = 1""",
    "op7_mixing": rf"""
WITH RECURSIVE docs AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS tokens,
    coalesce('=' || source, 'null') AS s, {_d("'1|' || coalesce(doc_id::VARCHAR, '')", 1, 8)} % 256 AS b,
    {_d("'1|' || coalesce(doc_id::VARCHAR, '')", 9, 8)} % 256 AS p FROM documents),
blocks AS (SELECT s, b, sum(tokens)::BIGINT AS t, max(tokens) AS longest FROM docs GROUP BY ALL),
shares AS (SELECT s, sum(t)::BIGINT AS tokens FROM blocks GROUP BY ALL),
p AS (SELECT list(tokens / (SELECT sum(tokens) FROM shares)::DOUBLE) AS p FROM shares WHERE tokens > 0),
-- halve [0, 1] for the flattest mix that repeats no source more than twice
halves AS (SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi FROM p
    UNION ALL SELECT i + 1, CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END FROM (
        SELECT i, lo, hi, (lo + hi) / 2 AS mid,
            list_max(list_transform(p.p, lambda x: pow(x, (lo + hi) / 2 - 1))) / list_sum(list_transform(p.p, lambda x: pow(x, (lo + hi) / 2))) <= 2.0 AS ok
        FROM halves, p WHERE i < 45)),
chosen AS (SELECT CASE WHEN len(p.p) <= 2 THEN 0.0 WHEN list_max(list_transform(p.p, lambda x: pow(x, -1.0))) / len(p.p) <= 2.0 THEN 0.0
    ELSE ceil(hi * 1e6) / 1e6 END AS a FROM halves, p WHERE i = 45),
quotas AS (SELECT s, tokens, CASE WHEN tokens > 0 THEN floor(pow(tokens / (SELECT sum(tokens) FROM shares)::DOUBLE, a - 1)
    / (SELECT list_sum(list_transform(p.p, lambda x: pow(x, a))) FROM p) * tokens + 0.5)::BIGINT ELSE 0 END AS quota FROM shares, chosen),
plan AS (SELECT b.s, b.b, b.t, b.longest, e.epoch, CASE WHEN tokens > 0 THEN quota // tokens ELSE 1 END AS whole, CASE WHEN tokens > 0 THEN quota % tokens ELSE 0 END AS rest,
    md5('1|' || b.s || '|' || e.epoch || '|' || b.b) AS place
    FROM blocks b JOIN quotas q USING (s), LATERAL (SELECT unnest(range(1, CASE WHEN tokens > 0 THEN quota // tokens ELSE 1 END + 2)) AS epoch) e),
turns AS (SELECT *, row_number() OVER (PARTITION BY s, epoch ORDER BY place) AS turn FROM plan),
-- the last epoch, block by block: what fits in the room left is taken
walk AS (SELECT s, epoch, whole, rest, turn, b, longest, t <= rest AS taken, rest - CASE WHEN t <= rest THEN t ELSE 0 END AS room FROM turns
    WHERE epoch = whole + 1 AND rest > 0 AND turn = 1
    UNION ALL SELECT n.s, n.epoch, n.whole, n.rest, n.turn, n.b, n.longest, n.t <= w.room, w.room - CASE WHEN n.t <= w.room THEN n.t ELSE 0 END
    FROM walk w JOIN turns n ON n.s = w.s AND n.epoch = w.epoch AND n.turn = w.turn + 1),
ends AS (SELECT s, epoch, whole, rest, min(room) AS room FROM walk GROUP BY ALL),
-- of a block passed over the pieces that fit in what is left; of a source with nothing the smallest piece
cut AS (SELECT e.s, e.epoch, e.room, e.whole = 0 AND e.room = e.rest AS bare, w.b, w.turn FROM ends e JOIN walk w USING (s, epoch) WHERE e.room > 0 AND NOT w.taken
    QUALIFY row_number() OVER (PARTITION BY s, epoch ORDER BY w.longest, w.turn, w.b) = 1),
sized AS (SELECT c.s, c.epoch, c.room, c.bare, c.b, d.p, sum(d.tokens)::BIGINT AS t FROM cut c JOIN docs d ON d.s = c.s AND d.b = c.b GROUP BY ALL),
pieces AS (SELECT *, row_number() OVER (PARTITION BY s, epoch ORDER BY md5('1|' || s || '|' || epoch || '|' || b || '|' || p)) AS k FROM sized),
fill AS (SELECT s, epoch, b, p, k, t <= room AS taken, room - CASE WHEN t <= room THEN t ELSE 0 END AS room FROM pieces WHERE k = 1
    UNION ALL SELECT n.s, n.epoch, n.b, n.p, n.k, n.t <= f.room, f.room - CASE WHEN n.t <= f.room THEN n.t ELSE 0 END
    FROM fill f JOIN pieces n ON n.s = f.s AND n.epoch = f.epoch AND n.k = f.k + 1),
filled AS (SELECT s, epoch, min(room) AS room FROM fill GROUP BY ALL),
least AS (SELECT p.s, p.epoch, p.b, p.p FROM pieces p JOIN filled f USING (s, epoch) WHERE p.bare AND p.room = f.room AND p.t > 0
    QUALIFY row_number() OVER (PARTITION BY p.s, p.epoch ORDER BY p.t, p.p) = 1),
given AS (SELECT s, b, epoch, turn, NULL::BIGINT AS p FROM turns WHERE epoch <= whole
    UNION ALL SELECT s, b, epoch, turn, NULL FROM walk WHERE taken
    UNION ALL SELECT c.s, c.b, c.epoch, c.turn, x.p FROM cut c JOIN (SELECT s, epoch, p FROM fill WHERE taken UNION SELECT s, epoch, p FROM least) x USING (s, epoch))
SELECT d.doc_id, d.source, d.tokens, g.epoch::INT AS epoch, g.turn::INT AS turn FROM docs d JOIN given g ON g.s = d.s AND g.b = d.b AND (g.p IS NULL OR g.p = d.p)""",
    "op8_revisits": rf"""
WITH base AS (SELECT page_id, url, '"' || substr(md5(html), 1, 12) || '"' AS e1, '"2-' || substr(md5(html), 13, 12) || '"' AS e2, md5(html) AS m,
    length(html) AS n, (page_id * 37) % 200 AS start, {_d("page_id::VARCHAR", 1, 1)} AS d1, {_d("page_id::VARCHAR", 2, 1)} AS d2,
    {_d("page_id::VARCHAR", 3, 1)} AS d3, regexp_replace(regexp_replace(url, '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://', '') AS bare FROM pages),
named AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^www\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_replace(regexp_replace(regexp_extract(bare, '^[^/?]*(.*)$', 1), '[?&]utm_[a-z]+=[^&]*', '', 'g'), '^([^?&]*)&', '\1?'), '/+$', '') AS c FROM base),
rows AS (SELECT *, k = 0 OR (k = 2 AND d2 < 8) AS is_full, CASE WHEN k = 3 AND d2 < 8 THEN e2 ELSE e1 END AS known,
    CASE WHEN k = 3 AND d2 < 8 THEN 'v2' ELSE 'v0' END AS known_m FROM named, range(4) r(k)),
records AS (SELECT page_id * 4 + k AS record_id, c, k, n, {_DAY.format("start + k * 25 + d3")} AS "at", is_full,
    CASE WHEN is_full THEN CASE WHEN k = 0 THEN e1 ELSE e2 END WHEN d1 < 3 THEN 'W/' || known WHEN d1 < 5 THEN '"other"' WHEN d1 < 8 THEN NULL ELSE known END AS etag,
    CASE WHEN is_full THEN 'v' || k WHEN d3 < 8 THEN known_m END AS last_modified,
    CASE WHEN is_full THEN CASE WHEN k = 0 THEN m ELSE md5(m || '2') END END AS digest FROM rows),
joined AS (SELECT r.*, f.record_id AS f_id, f.etag AS f_etag, f.last_modified AS f_modified, f.digest AS f_digest, f.n AS f_n
    FROM records r LEFT JOIN records f ON NOT r.is_full AND f.is_full AND f.c = r.c AND f."at" < r."at"
    QUALIFY row_number() OVER (PARTITION BY r.record_id ORDER BY f."at" DESC NULLS LAST, f.record_id DESC) = 1),
judged AS (SELECT *, CASE WHEN is_full THEN 'full' WHEN f_id IS NULL THEN 'no_response' WHEN etag IS NULL AND last_modified IS NULL THEN 'no_validator'
    WHEN etag IS NOT NULL AND regexp_replace(etag, '^W/', '') = regexp_replace(f_etag, '^W/', '') THEN 'resolved'
    WHEN etag IS NULL AND last_modified = f_modified THEN 'resolved' ELSE 'validator_mismatch' END AS status FROM joined)
SELECT record_id, "at", CASE WHEN is_full THEN 'response' ELSE 'revisit' END AS kind, status, CASE WHEN status = 'resolved' THEN f_id END AS refers_to,
    CASE WHEN status = 'resolved' THEN f_digest ELSE digest END AS digest,
    concat_ws(';', 'cache-control=max-age=' || (k * 60), 'content-length=' || CASE WHEN status = 'resolved' THEN f_n WHEN is_full THEN n ELSE 0 END,
        CASE WHEN is_full OR status = 'resolved' THEN 'content-type=text/html' END, 'date=' || "at"::VARCHAR,
        'etag=' || CASE WHEN status = 'resolved' THEN coalesce(etag, f_etag) ELSE etag END,
        CASE WHEN NOT is_full AND status <> 'resolved' THEN 'set-cookie=s=1' END) AS headers FROM judged""",
    "op11_fill_in_middle": rf"""
WITH drawn AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
cut AS (SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
    ('0x' || h[17:24])::BIGINT % 100 AS h3, ('0x' || h[25:32])::BIGINT % 100 AS h4 FROM drawn),
parts AS (SELECT doc_id, t, n, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
    array_to_string(u[greatest(a, b) + 1:], '') AS s, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
    WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM cut)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256 FROM parts""",
    "op13_chat": rf"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, k, CASE k WHEN 0 THEN 'user' ELSE 'assistant' END, '{ODD_TURN}' FROM range(2) r(k)),
sized AS (SELECT *, length(text) + length(regexp_replace(text, '[^\\]', '', 'g')) + len(regexp_extract_all(text, '</?s>|\[/?(?:INST|ROLE)\]')) AS n_text,
    length(role) + length(regexp_replace(role, '[^\\]', '', 'g')) + len(regexp_extract_all(role, '</?s>|\[/?(?:INST|ROLE)\]')) AS n_role FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(n_text + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE n_role + 19 END)::BIGINT AS formatted_chars FROM sized GROUP BY conv_id""",
}
