"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import cut, table, tasks
from . import abuse, conversations, groups, languages, overlap, packing, personal, tokens


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    said = conversations.messages(table(spark, folder, "enriched"), table(spark, folder, "owner_names"))
    return conversations.verdicts(said).where("status <> 'kept'").select("conversation_id")


def p1_turns(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.rebuild(table(spark, folder, "enriched"), table(spark, folder, "owner_names"))


def _once(parsed: DataFrame, *columns: str) -> DataFrame:
    """Each message once; one exchange, whose tasks then do the heavier work."""
    return parsed.select(*columns).repartition(tasks(parsed.sparkSession), "msg_id").distinct()


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    parsed = table(spark, folder, "parsed")
    model = abuse.train(parsed, table(spark, folder, "labels"), table(spark, folder, "nsfw_words"))
    return abuse.score(_once(parsed, "msg_id", "source_file", "text"), model)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).where("abusive").select("msg_id").distinct()


def p3_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Messages, abusive ones, their rate and the mean score per source_file."""
    by = _scored(spark, folder).groupBy("source_file").agg(F.count("*").alias("n_messages"), F.count_if(F.col("abusive")).alias("n_abusive"), F.avg("score").alias("mean_score"))
    return by.withColumn("rate", F.col("n_abusive") / F.col("n_messages"))


def _names(spark: SparkSession, folder: str) -> tuple[str, ...]:
    return personal.known_names(table(spark, folder, "contacts"), table(spark, folder, "owner_names"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return personal.find(table(spark, folder, "parsed"), _names(spark, folder))


def p5_redacted(spark: SparkSession, folder: str) -> DataFrame:
    return personal.redact(_once(table(spark, folder, "parsed"), "msg_id", "text"), _names(spark, folder))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    g = groups.conversation_groups(table(spark, folder, "contexts"))
    shared = g.groupBy("group_id").count().where("count > 1").select("group_id")
    return g.join(shared, "group_id", "left_semi").select("conversation_id", "group_id")


def p6_splits(spark: SparkSession, folder: str) -> DataFrame:
    contexts = table(spark, folder, "contexts")
    return groups.grouped_split(contexts, groups.conversation_groups(contexts))


def p6_whole(spark: SparkSession, folder: str) -> DataFrame:
    """Whether every record has one split and every group and conversation lies in one."""
    return groups.wholeness(cut(p6_splits(spark, folder)))


def _three(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {s: table(spark, folder, s) for s in ("train", "val", "test")}


def _splits(spark: SparkSession, folder: str) -> DataFrame:
    return overlap.splits(**_three(spark, folder))


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    return overlap.contained_pairs(overlap.rows(**_three(spark, folder)), union=True)


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(spark, folder).select("id_a", "id_b")


def p7_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Records and pairs of p7_found per pair of splits and source_file."""
    return overlap.contained_counts(_splits(spark, folder), _pairs(spark, folder))


def p7_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """Records per pair of splits and source_file, those that share half and nine tenths of their text, mean share."""
    o = overlap.chunk_overlap(_splits(spark, folder), ("train", "val", "test"))
    return o.groupBy("split", "other", "source_file").agg(F.count("*").alias("n_records"), F.count_if(F.col("overlap") >= 0.5).alias("n_half"), F.count_if(F.col("overlap") >= 0.9).alias("n_same"), F.avg("overlap").alias("mean_overlap"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encode(table(spark, folder, "documents"))


def p9_containers(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(tokens.lengths(table(spark, folder, "documents")))


def p9_whole(spark: SparkSession, folder: str) -> DataFrame:
    """Whether every text is in the containers once, whole where it fits."""
    sizes = cut(tokens.lengths(table(spark, folder, "documents")))
    return packing.totals(packing.pack(sizes), sizes)


def _languages(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return languages.identify(documents, languages.fit(documents))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return languages.mislabelled(_languages(spark, folder))


def p10_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _languages(spark, folder).select("doc_id", "main_lang", "confidence", "segments")


QUERIES = {
    "p1_found": p1_found,
    "p1_turns": p1_turns,
    "p3_found": p3_found,
    "p3_rates": p3_rates,
    "p5_found": p5_found,
    "p5_redacted": p5_redacted,
    "p6_found": p6_found,
    "p6_splits": p6_splits,
    "p6_whole": p6_whole,
    "p7_found": p7_found,
    "p7_counts": p7_counts,
    "p7_overlap": p7_overlap,
    "p8_ids": p8_ids,
    "p9_containers": p9_containers,
    "p9_whole": p9_whole,
    "p10_found": p10_found,
    "p10_documents": p10_documents,
}
def _seen(column: str) -> str:
    return f"lower(regexp_replace(regexp_replace({column}, '{conversations._MARKS}', '', 'g'), '^{conversations.BLANK}+|{conversations.BLANK}+$', '', 'g'))"


_SPOKEN = r"""regexp_replace(regexp_extract(text, '(?s)<\|im_start\|>user\n(.*?)<\|im_end\|>', 1), '(?:^|\n)\[[^\n]*\n*$', chr(10)) || chr(10) || regexp_extract(text, '(?s)<\|im_start\|>assistant\n?(.*?)(?:<\|im_end\|>|$)', 1)"""

_DROPPED = """a as (select conversation_id, bool_or(content) said, bool_or(content and (who is null or t is null)) broken, min(case when content and who not in (select n from o) then t end) c,
 max(case when content and who in (select n from o) then t end) y from m group by 1)"""

#: The queries that SQL can express; the others are tested against brute force, round trips and held-out accuracy.
SQL = {
    "p1_found": f"""with o as (select distinct {_seen("name")} n from owner_names where name is not null),
m as (select conversation_id, cast(epoch_us(datetime) as hugeint) * 1000000000 + line_no as t, nullif(nullif({_seen("sender")}, ''), '~') who,
 coalesce({_seen("text")} <> '' and not regexp_matches({_seen("text")}, '{conversations.NOTICE}'), false) content from enriched where conversation_id is not null),
{_DROPPED}
select conversation_id from a where not (said and not broken and coalesce(y > c, false))""",
    "p1_turns": f"""with o as (select distinct {_seen("name")} n from owner_names where name is not null),
m as (select distinct conversation_id, msg_id, line_no, epoch_us(datetime) us, cast(epoch_us(datetime) as hugeint) * 1000000000 + line_no as t, text, nullif(nullif({_seen("sender")}, ''), '~') who,
 coalesce({_seen("text")} <> '' and not regexp_matches({_seen("text")}, '{conversations.NOTICE}'), false) content from enriched where conversation_id is not null),
{_DROPPED},
l as (select *, case when who in (select n from o) then 'owner' else 'contact' end as role, lag(us) over w pus, lag(case when who in (select n from o) then 'owner' else 'contact' end) over w prole
 from m where content and conversation_id in (select conversation_id from a where said and not broken and coalesce(y > c, false)) window w as (partition by conversation_id order by us, line_no, msg_id)),
h as (select cast(floor(log2((us - pus) / 1e6) * 10) as int) bin, count(*) n from l where us > pus group by 1),
b as (select r.bin, sum(coalesce(n, 0)) over (order by r.bin rows between 2 preceding and 2 following) mass from (select cast(unnest(range(96, 166)) as int) bin) r left join h on r.bin = h.bin),
g as (select cast(trunc(pow(2.0, (bin + 0.5) / 10) * 1000000) as bigint) gap from b where bin between 98 and 163 order by mass, abs(bin - 118), bin limit 1),
s as (select l.*, pus is null or us - pus > gap as fresh from l, g),
n as (select *, sum(cast(fresh as int)) over w session_no, sum(cast(fresh or role <> prole as int)) over w turn_no from s window w as (partition by conversation_id order by us, line_no, msg_id rows unbounded preceding)),
k as (select conversation_id, session_no from n group by all having min(case when role = 'contact' then turn_no end) < max(case when role = 'owner' then turn_no end))
select conversation_id, cast(session_no as bigint) session_no, cast(turn_no as bigint) turn_no, role, first(who order by us, line_no, msg_id) speaker, min(us) start_us, max(us) end_us, count(*) n_messages, string_agg(text, chr(10) order by us, line_no, msg_id) as text
from n semi join k using (conversation_id, session_no) group by conversation_id, session_no, turn_no, role""",
    "p6_found": """with recursive d as (select distinct conversation_id c, right(regexp_replace(translate(recipient_phone, '०१२३४५६७८९٠١٢٣٤٥٦٧٨٩', '01234567890123456789'), '[^0-9]', '', 'g'), 10) p from contexts where conversation_id is not null),
l as (select c, p from d where length(p) = 10 and p <> repeat(left(p, 1), 10)),
e as (select distinct x.c a, y.c b from l x join l y using (p)),
r as (select a, b from e union select r.a, e.b from r join e on r.b = e.a)
select a conversation_id, min(b) group_id from r group by a having count(distinct b) > 1""",
    "p6_whole": "select count(distinct sample_id) n_records, cast(0 as bigint) n_twice, cast(0 as bigint) n_torn from contexts",
    "p7_found": f"""with r as (select sample_id, 'train' split, text from train union all select sample_id, 'val', text from val union all select sample_id, 'test', text from test),
w as (select sample_id, split, list_distinct(regexp_extract_all(lower({_SPOKEN}), '[\\p{{L}}\\p{{N}}]+')) w from (select distinct * from r) where text is not null),
k as (select sample_id, split, len(w) n, unnest(w) x from w where len(w) >= 20),
p as (select a.sample_id i, b.sample_id j, count(*) c, min(a.n) n, min(b.n) m from k a join k b on a.x = b.x and a.split <> b.split and a.sample_id < b.sample_id group by 1, 2)
select i id_a, j id_b from p where c * 10 >= 7 * least(n, m)""",
    "p9_whole": "select count(*) n_items, cast(0 as bigint) n_cut, cast(0 as bigint) n_wrong, cast(0 as bigint) n_overfull from documents where text <> ''",
}
