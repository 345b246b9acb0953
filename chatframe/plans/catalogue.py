"""Registered queries of the chat-log operators over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean, message
from ..functions.pytext import LINE_BREAK, WS, W
from ..operators import contexts, evaluation, split, stats
from ..operators.contacts import Contacts, tag_relationships
from ..operators.dedup import cutoff, dedup_messages
from ..operators.ordered import micros, order_features, time_slices
from ..runtime import new_folder, table
from ..sources import records
from ..sources.exports import SYSTEM_MARKERS, chat_name, fold_lines, header_time, is_system, parse_exports, write_exports

YOU = "Tavi"
TIES = ("line_no", "msg_id")
AS_OF, MONTHS = "2025-06-01 00:00:00", 24
#: A neutral list for the word filter.
BUCKETS = ("english", "hindi")
LISTED = ("kal", "aaj", "library", "किताब")


def _messages(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Each message once, with the columns that the query needs."""
    return table(spark, folder, "enriched").select("msg_id", *columns or ("conversation_id", "source_file", "line_no", "datetime", "sender", "text", "is_media", "relationship")).distinct()


def _ordered(spark: SparkSession, folder: str, scope: str, *columns: str) -> DataFrame:
    times = table(spark, folder, "enriched").select(micros(F.col("datetime")).alias("_us"))  # one column, before any shuffle
    return order_features(_messages(spark, folder, "source_file", "line_no", "datetime", "sender", *columns), YOU, scope, ties=TIES, slices=time_slices(times))


def _windows(spark: SparkSession, folder: str) -> DataFrame:
    return contexts.context_windows(message.calendar_features(_ordered(spark, folder, "chat", "conversation_id", "text", "relationship")), YOU, ties=TIES)


def context_windows(spark: SparkSession, folder: str) -> DataFrame:
    return _windows(spark, folder).select("msg_id", "context", "reply", "relationship", "hour", "day_name", "is_weekend", "timedelta_prev", "position", "reply_chain_depth")


def recipient_last_other(spark: SparkSession, folder: str) -> DataFrame:
    return _windows(spark, folder).select("msg_id", "recipient_name")


def context_chatml(spark: SparkSession, folder: str) -> DataFrame:
    return _windows(spark, folder).select("msg_id", contexts.chatml(YOU).alias("text"))


def prompts(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "contexts").select("sample_id", "context", "relationship", "datetime").distinct()
    lines = F.when(F.col("context") != contexts.NO_CONTEXT, F.split("context", "\n"))
    return c.select("sample_id", contexts.prompt(lines, F.coalesce("relationship", F.lit("unknown")), YOU, F.col("datetime")).alias("prompt"))


def running_context(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "contexts").select("sample_id", "context", "reply").distinct()
    return c.select("sample_id", F.array_join(contexts.append_context(F.split("context", "\n"), F.col("reply"), 3), "\n").alias("lines"))


def temporal_features(spark: SparkSession, folder: str) -> DataFrame:
    return message.calendar_features(_ordered(spark, folder, "global")).select("msg_id", "timedelta_prev", "hour", "day_of_week", "day_name", "is_weekend", "month")


def sessionize_global(spark: SparkSession, folder: str) -> DataFrame:
    return _ordered(spark, folder, "global").select("msg_id", "session_break", "session_id")


def sessionize_chat(spark: SparkSession, folder: str) -> DataFrame:
    return _ordered(spark, folder, "chat").select("msg_id", "timedelta_prev", "session_break", "session_id")


def session_positions(spark: SparkSession, folder: str) -> DataFrame:
    return _ordered(spark, folder, "chat").select("msg_id", "position")


def positions_global(spark: SparkSession, folder: str) -> DataFrame:
    return _ordered(spark, folder, "global").select("msg_id", "position")


def ghosted_global(spark: SparkSession, folder: str) -> DataFrame:
    return _ordered(spark, folder, "global").select("msg_id", "ghosted")


def context_windows_global(spark: SparkSession, folder: str) -> DataFrame:
    rows = contexts.context_windows(message.calendar_features(_ordered(spark, folder, "global", "conversation_id", "text", "relationship")), YOU, ties=TIES)
    return rows.select("msg_id", "context", "reply", "recipient_name", "timedelta_prev", "position", "reply_chain_depth")


def reply_chain_depth(spark: SparkSession, folder: str) -> DataFrame:
    return _ordered(spark, folder, "global").select("msg_id", "reply_chain_depth")


def reply_depth_events(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").select("event_id", F.col("ts").alias("datetime"), F.concat(F.lit("user_"), "user_id").alias("source_file"), F.col("event_type").alias("sender"))
    return order_features(e, "purchase", "chat", ties=("event_id",)).select("event_id", "timedelta_prev", "session_id", "position", "reply_chain_depth", "ghosted")


def ghosted_chat(spark: SparkSession, folder: str) -> DataFrame:
    return _ordered(spark, folder, "chat").select("msg_id", "ghosted")


def conversation_id(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "enriched").select("source_file").distinct().select("source_file", message.conversation_id(F.col("source_file")).alias("conversation_id"))


def message_features(spark: SparkSession, folder: str) -> DataFrame:
    f = message.message_features(_messages(spark, folder, "text"))
    return f.select("msg_id", "message_length", "word_count", "ends_ellipsis", "ends_question", "has_caps_word", "is_single_word", "is_very_short")


def emoji_features(spark: SparkSession, folder: str) -> DataFrame:
    return message.message_features(_messages(spark, folder, "text")).select("msg_id", "emoji_count", "has_emoji")


def _documents(spark: SparkSession, folder: str, cleaned) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", cleaned.alias("cleaned"))


def clean_pii(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, clean.mask_pii(F.col("text")))


def clean_urls(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, F.regexp_replace("text", clean.URL, "[URL]"))


def clean_devanagari(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, clean.normalise_space(clean.remove_devanagari(F.col("text"))))


def clean_english(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, clean.remove_words(F.col("text")))


def clean_wordlist_filter(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, clean.mask_words(F.col("text"), LISTED, "[WORD]"))


def clean_buckets(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "parsed").select("msg_id", "text").distinct()
    return clean.clean_messages(rows, devanagari=False, buckets=BUCKETS)


def clean_lists(spark: SparkSession, folder: str) -> DataFrame:
    """The buckets of a table of words, a bounded list."""
    lists: dict[str, list[str]] = {}
    for r in table(spark, folder, "nsfw_words").where("word is not null").select("bucket", "word").distinct().orderBy("word").limit(10_000).collect():
        lists.setdefault(r["bucket"], []).append(r["word"])
    rows = table(spark, folder, "parsed").select("msg_id", "text").distinct()
    return clean.clean_messages(rows, devanagari=False, pii=False, buckets=tuple(sorted(lists)), lists=lists)


def clean_full(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean_messages(_messages(spark, folder, "text").select("msg_id", "text"), english=True, masked=LISTED)


def clean_preview_diff(spark: SparkSession, folder: str) -> DataFrame:
    return stats.cleaning_preview(_messages(spark, folder, "datetime", "text"), clean.clean_text(F.col("text")), 20, "msg_id")


def clean_effect(spark: SparkSession, folder: str) -> DataFrame:
    return stats.cleaning_effect(_messages(spark, folder, "text"), clean.clean_text(F.col("text")))


def relationships(spark: SparkSession, folder: str) -> DataFrame:
    book = Contacts.from_table(table(spark, folder, "contacts"), YOU)
    book = Contacts(book.names, (("group", "group_close"), ("gang", "group_formal")), book.default, YOU)
    return tag_relationships(_messages(spark, folder, "source_file", "sender"), book).select("msg_id", "recipient_phone", "relationship")


def dedup(spark: SparkSession, folder: str) -> DataFrame:
    twice = table(spark, folder, "enriched").select("datetime", "sender", "text", "source_file", "line_no", "msg_id")
    return dedup_messages(twice.unionByName(twice), order=("source_file", "line_no", "msg_id")).select("msg_id", "datetime", "sender", "text")


def date_cutoff(spark: SparkSession, folder: str) -> DataFrame:
    return cutoff(_messages(spark, folder, "datetime"), MONTHS, AS_OF).select("msg_id", "datetime")


def _split(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "contexts").select("sample_id", "relationship", "reply").distinct()
    return split.stratified_split(split.reply_length(rows), "relationship", "sample_id")


def stratified_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder).groupBy("relationship", "split").agg(F.count("*").alias("n"))


def size_verdict(spark: SparkSession, folder: str) -> DataFrame:
    return stats.size_verdict(_split(spark, folder))


def stats_parsed(spark: SparkSession, folder: str) -> DataFrame:
    return stats.corpus_stats(_messages(spark, folder, "source_file", "datetime", "is_media"))


def stats_you(spark: SparkSession, folder: str) -> DataFrame:
    s = stats.your_stats(message.message_features(_messages(spark, folder, "sender", "text")), YOU)
    return s.withColumns({c: F.round(c, 6) for c in ("mean_length", "mean_words")})


def by_relationship_bar(spark: SparkSession, folder: str) -> DataFrame:
    return stats.with_bar(stats.value_counts(_messages(spark, folder, "relationship"), "relationship"))


def top_hours(spark: SparkSession, folder: str) -> DataFrame:
    return stats.top_hours(_messages(spark, folder, "datetime"))


def top_senders_pct(spark: SparkSession, folder: str) -> DataFrame:
    return stats.share_of_total(_messages(spark, folder, "sender"), "sender").orderBy(F.desc("n_messages"), "sender").limit(8).withColumn("percent", F.round("percent", 6))


def candidate_names(spark: SparkSession, folder: str) -> DataFrame:
    return stats.candidate_names(_messages(spark, folder, "sender"))


def recent_messages(spark: SparkSession, folder: str) -> DataFrame:
    return stats.recent_messages(_messages(spark, folder, "datetime", "sender", "text"), 25, "msg_id")


def _rendered(spark: SparkSession, folder: str) -> DataFrame:
    m = _messages(spark, folder, "source_file", "datetime", "sender", "text").where("datetime is not null and source_file is not null and sender is not null and text is not null")
    whole = F.concat(F.date_format("datetime", "dd/MM/yyyy, HH:mm"), F.lit(" - "), "sender", F.lit(": "), "text")
    return m.select("source_file", "msg_id", F.posexplode(F.split(whole, LINE_BREAK)).alias("i", "line")).select("source_file", (F.col("msg_id") * 1000 + F.col("i")).alias("pos"), "line")


def parse_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return fold_lines(_rendered(spark, folder)).select("source_file", (F.col("line_no") / 1000).cast("bigint").alias("msg_id"), "datetime", "sender", "text", "is_media")


def _written_exports(spark: SparkSession, folder: str) -> str:
    """A new folder of one text file per chat."""
    at = new_folder(spark, "exports")
    write_exports(_rendered(spark, folder), at)
    return at


def export_files(spark: SparkSession, folder: str) -> DataFrame:
    """The messages rendered as export files, one per chat, and read back."""
    read = parse_exports(spark, _written_exports(spark, folder), dedup=False, check=False)
    return dedup_messages(read.withColumn("source_file", chat_name(F.col("source_file")))).select("source_file", "datetime", "sender", "text", "is_media")


def stage_file(spark: SparkSession, folder: str) -> DataFrame:
    """A stage table written and read back."""
    at = new_folder(spark, "stage")
    records.write_stage(_messages(spark, folder, "datetime", "sender", "text"), at)
    return records.read_stage(spark, at).select("msg_id", "datetime", "sender", "text")


def _written_splits(spark: SparkSession, folder: str) -> str:
    at = new_folder(spark, "splits")
    records.write_splits(_records(spark, folder), at)
    return at


def split_files(spark: SparkSession, folder: str) -> DataFrame:
    """The samples of each split written as JSON Lines and read back."""
    at = _written_splits(spark, folder)
    return records.read_splits(spark, {s: f"{at}/{s}.jsonl" for s in ("train", "val", "test")})


def split_file_lines(spark: SparkSession, folder: str) -> DataFrame:
    return records.line_counts(spark, f"{_written_splits(spark, folder)}/*.jsonl")


def parse_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").select("event_id", "ts")
    forms = {"dmy4": ("dd/MM/yyyy", "HH:mm"), "mdy4": ("MM/dd/yyyy", "H:mm"), "dmy2": ("d/M/yy", "hh:mm a"), "mdy2": ("M/d/yy", "h:mm a")}
    return e.select("event_id", *(header_time(F.date_format("ts", d), F.date_format("ts", t)).alias(n) for n, (d, t) in forms.items()))


def system_filter(spark: SparkSession, folder: str) -> DataFrame:
    return _messages(spark, folder, "sender", "text").where(~is_system(F.coalesce("sender", F.lit("")), F.coalesce("text", F.lit("")))).select("msg_id", clean.is_media(F.col("text")).alias("is_media"))


def _records(spark: SparkSession, folder: str) -> DataFrame:
    parts = [table(spark, folder, s).select("sample_id", "text", F.lit(s).alias("split")) for s in ("train", "val", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def chatml_extract(spark: SparkSession, folder: str) -> DataFrame:
    t = F.col("text")
    return _records(spark, folder).where("text is not null").select("sample_id", evaluation.user_content(t).alias("context"), evaluation.true_reply(t).alias("reply"), evaluation.prompt_prefix(t).alias("prompt"))


def eval_previews(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.eval_samples(_records(spark, folder).where("split = 'test'"), 50, "sample_id").select("id", "sample_id", "context_preview", "true_preview")


def eval_last_context(spark: SparkSession, folder: str) -> DataFrame:
    rows = _records(spark, folder).where("text is not null")
    return rows.select("sample_id", F.substring(evaluation.last_context_line(evaluation.user_content(F.col("text"))), 1, 70).alias("last_line"))


def eval_summary(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "contexts").select("sample_id", "reply", "context").distinct()
    pairs = c.select(F.col("reply").alias("true"), evaluation.value_or_preview(F.element_at(F.split("context", "\n"), -1), F.col("reply")).alias("generated"))
    s = evaluation.eval_summary(pairs)
    return s.withColumns({c: F.round(c, 6) for c, t in s.dtypes if t == "double"})


def split_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _records(spark, folder).groupBy("split").agg(F.count("*").alias("n_lines"))


def jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    line = F.to_json(F.struct("text"))
    return _records(spark, folder).select("sample_id", F.from_json(line, "text string")["text"].alias("text"))


_LIST = (
    context_windows, recipient_last_other, context_chatml, prompts, running_context, temporal_features, sessionize_global, sessionize_chat, session_positions, reply_chain_depth, positions_global, ghosted_global, context_windows_global, clean_buckets, clean_lists, export_files, stage_file, split_files, split_file_lines,
    reply_depth_events, ghosted_chat, conversation_id, message_features, emoji_features, clean_pii, clean_urls, clean_devanagari, clean_english, clean_wordlist_filter, clean_full,
    clean_preview_diff, clean_effect, date_cutoff, stratified_split_counts, size_verdict, stats_parsed, stats_you, by_relationship_bar, top_hours, top_senders_pct, candidate_names,
    recent_messages, parse_roundtrip, parse_timestamps, system_filter, chatml_extract, eval_previews, eval_last_context, eval_summary, split_lines, jsonl_roundtrip,
)
QUERIES = {f.__name__: f for f in _LIST} | {"tag_relationships": relationships, "dedup_messages": dedup}

# ---- SQL -------------------------------------------------------------------------------------------------------------

_M = f"""m as (select *, epoch_us(datetime) us, coalesce('c' || source_file, 'n') chat, coalesce(sender = '{YOU}', false) you from
 (select distinct msg_id, conversation_id, source_file, line_no, datetime, sender, text, is_media, relationship from enriched))"""


def _features(scope: str, rows: str = _M + ",\nr as (select * from m where datetime is not null)", ties: str = "line_no, msg_id") -> str:
    part = "" if scope == "global" else "partition by chat"
    return f"""with {rows},
f1 as (select *, lag(us) over o pus, lag(chat) over o pchat, lag(sender) over o psender, row_number() over o rn, lead(us) over o nus from r window o as ({part} order by us, chat, {ties})),
f2 as (select *, greatest(0, coalesce((us - pus) / 1e6, 0)) timedelta_prev, rn = 1 or chat <> pchat or (us - pus) / 1e6 > 3600 session_break,
 not you and coalesce((nus - us) / 1e6 > 86400, false) ghosted, not you and (rn = 1 or sender is distinct from psender) turn from f1),
f3 as (select *, cast(sum(cast(session_break as int)) over (partition by chat order by us, {ties} rows unbounded preceding) as bigint) session_id,
 sum(cast(turn as int)) over ({part} order by us, chat, {ties} rows unbounded preceding) c from f2),
f4 as (select *, cast(c - coalesce(max(case when you then c end) over ({part} order by us, chat, {ties} rows unbounded preceding), 0) as bigint) reply_chain_depth,
 count(*) over (partition by chat, session_id) sn, row_number() over (partition by chat, session_id order by us, {ties}) sr from f3),
f as (select *, case when sn = 1 then 'mid' when sr = 1 then 'opener' when sr = sn then 'closer' else 'mid' end as position from f4)
"""


def _g(text: str, pattern: str, to: str) -> str:
    return f"regexp_replace({text}, '{pattern}', '{to}', 'g')"


_STRIP = rf"^[{WS}]+|[{WS}]+$"


def _strip(t: str) -> str:
    return _g(t, _STRIP, "")


def _tokens(t: str) -> str:
    return f"list_filter(regexp_split_to_array({t}, '[{WS}]+'), lambda x: x <> '')"


def _pii(t: str) -> str:
    twelve = rf"(^|[^{W}])\p{{Nd}}{{4}}[{WS}]?\p{{Nd}}{{4}}[{WS}]?\p{{Nd}}{{4}}($|[^{W}])"
    t = _g(_g(_g(t, clean.URL, "[URL]"), clean.PHONE, "[PHONE]"), rf"[{W}][{W}.+-]*@[{W}-]+\.[{W}]+", "[EMAIL]")
    t = _g(t, rf"[{W}][{W}.]*@(okaxis|oksbi|okicici|ybl|paytm|upi)($|[^{W}])", r"[UPI]\2")
    return _g(_g(t, twelve, r"\1[ID]\2"), twelve, r"\1[ID]\2")


def _values(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_ENGLISH = _values(clean.ENGLISH_WORDS.split())
_EDGE = rf"^[^{W}\x{{0900}}-\x{{097F}}]+|[^{W}\x{{0900}}-\x{{097F}}]+$"


def _masked(t: str, mask: str, words=LISTED) -> str:
    return f"array_to_string(list_transform({_tokens(t)}, lambda x: case when list_contains({words if isinstance(words, str) else _values(words)}, {_g('lower(x)', _EDGE, '')}) then '{mask}' else x end), ' ')"


def _without_english(t: str) -> str:
    return f"array_to_string(list_filter({_tokens(t)}, lambda x: not list_contains({_ENGLISH}, lower(x))), ' ')"


def _space(t: str) -> str:
    return _strip(_g(t, rf"[{WS}]{{{{2,}}}}".replace("{{", "{").replace("}}", "}"), " "))


_MEDIA = "(contains(text, '<Media omitted>') or contains(lower(text), 'image omitted'))"


def _cleaned(steps: str) -> str:
    return f"case when text is null or text = '' or {_MEDIA} or length({steps}) <= 1 then null else {steps} end"


def _redact(t: str, keep: int) -> str:
    s = _strip(t)
    return f"case when length({s}) <= {keep} then {s} else left({s}, {keep}) || '...' end"


_PLAIN_CLEAN = _cleaned(_space(_pii(_g("text", clean.DEVANAGARI, ""))))
_FULL_CLEAN = _cleaned(_space(_masked(_without_english(_pii(_g("text", clean.DEVANAGARI, ""))), "[NSFW]")))
_BUCKETS_CLEAN = _cleaned(_space(_masked(_pii("text"), "[NSFW]", clean.active_words(BUCKETS))))
_LISTS_CLEAN = _cleaned(_space(_masked("text", "[NSFW]", "listed")))
_SYSTEM = contexts.SYSTEM_PROMPT.format(your_name=YOU).replace("'", "''")
_OPEN = f"'<|im_start|>system\n{_SYSTEM}\n<|im_end|>\n<|im_start|>user\n'"


def _windows_sql(scope: str) -> str:
    return _features(scope) + f""", w as (select *, list({{'s': coalesce(sender, 'null'), 't': coalesce(text, 'null')}}) over (partition by conversation_id, source_file, session_id order by us, line_no, msg_id rows between 5 preceding and 1 preceding) l from f),
c as (select *, case when len(coalesce(l, [])) = 0 then '{contexts.NO_CONTEXT}' else array_to_string(list_transform(l, lambda x: x.s || ': ' || x.t), chr(10)) end context, text reply,
 coalesce(list_filter(l, lambda x: x.s <> '{YOU}')[-1].s, 'unknown') recipient_name, cast(hour(datetime) as int) h, dayname(datetime) day_name, cast(trunc(timedelta_prev) as bigint) since from w where you)
"""


_W = _windows_sql("chat")
_RECORDS = "r as (select sample_id, text, 'train' split from train union all select sample_id, text, 'val' from val union all select sample_id, text, 'test' from test)"
_USER = _strip(r"regexp_extract(text, '(?s)<\|im_start\|>user\n(.*?)<\|im_end\|>', 1)")
_REPLY = _strip(r"regexp_extract(text, '(?s)^.*?<\|im_start\|>assistant\n(.*)<\|im_end\|>', 1)")
_PREFIX = "split_part(text, '<|im_start|>assistant' || chr(10), 1) || '<|im_start|>assistant' || chr(10)"
_MARKED = " or ".join(f"contains(lower(coalesce(text, '')), '{m}')" for m in SYSTEM_MARKERS)
_SPLIT = """with x as (select distinct sample_id, relationship, reply from contexts), n as (select relationship, count(*) n from x where length(reply) between 2 and 500 group by 1),
k as (select relationship, n, case when n < 10 then 0 else greatest(1, cast(floor(cast(n as double) * (cast(1 as double) - cast(0.85 as double) - cast(0.10 as double))) as bigint)) end te,
 case when n < 10 then 0 else greatest(1, cast(floor(cast(n as double) * cast(0.10 as double)) as bigint)) end va from n)
"""
_EVENTS = "r as (select event_id, epoch_us(ts) us, 'cuser_' || user_id chat, event_type sender, event_type = 'purchase' you from events)"
_MIN = "date_trunc('minute', ts)"
_SWAPPED = "case when day(ts) <= 12 then make_timestamp(year(ts), day(ts), month(ts), hour(ts), minute(ts), 0.0) else date_trunc('minute', ts) end"

_PARSED = f"""with {_M}, a as (select *, translate(sender, chr(8239) || chr(160), '  ') who, list_transform(regexp_split_to_array(translate(text, chr(8239) || chr(160), '  '), '{LINE_BREAK}'), lambda x: {_strip('x')}) l,
 regexp_split_to_array(translate(text, chr(8239) || chr(160), '  '), '{LINE_BREAK}')[1] head from m where datetime is not null and source_file is not null and sender is not null and text is not null)
select source_file, msg_id, date_trunc('minute', datetime) datetime, {_strip('who')} sender, array_to_string(list_concat([l[1]], list_filter(l[2:], lambda x: x <> '')), ' ') as text, contains(head, '<Media omitted>') or contains(lower(head), 'image omitted') is_media from a
where {_strip('who')} not in ('', '~') and not ({' or '.join(f"contains(lower(head), '{m}')" for m in SYSTEM_MARKERS)})"""

SQL = {
    "context_windows": _W + "select msg_id, context, reply, relationship, h as hour, day_name, isodow(datetime) in (6, 7) is_weekend, since timedelta_prev, position, reply_chain_depth from c",
    "recipient_last_other": _W + "select msg_id, recipient_name from c",
    "context_chatml": _W + f"select msg_id, {_OPEN} || context || chr(10) || '[Relationship: ' || coalesce(relationship, 'null') || ' | Hour: ' || h || ' | Day: ' || day_name || ' | Since last msg: ' || since || 's | Position: ' || position || ']\n<|im_end|>\n<|im_start|>assistant\n' || coalesce(reply, 'null') || '<|im_end|>' as text from c",
    "prompts": f"select sample_id, {_OPEN} || context || chr(10) || '[Relationship: ' || coalesce(relationship, 'unknown') || ' | Hour: ' || hour(datetime) || ' | Day: ' || dayname(datetime) || ']\n<|im_end|>\n<|im_start|>assistant\n' as prompt from (select distinct sample_id, context, relationship, datetime from contexts)",
    "running_context": "select sample_id, array_to_string(list_slice(l, greatest(len(l) - 2, 1), len(l)), chr(10)) as lines from (select sample_id, list_append(string_split(context, chr(10)), reply) l from (select distinct sample_id, context, reply from contexts))",
    "temporal_features": _features("global") + "select msg_id, timedelta_prev, cast(hour(datetime) as int) as hour, cast(isodow(datetime) - 1 as int) day_of_week, dayname(datetime) day_name, isodow(datetime) in (6, 7) is_weekend, cast(month(datetime) as int) as month from f",
    "sessionize_global": _features("global") + "select msg_id, session_break, session_id from f",
    "sessionize_chat": _features("chat") + "select msg_id, timedelta_prev, session_break, session_id from f",
    "session_positions": _features("chat") + "select msg_id, position from f",
    "reply_chain_depth": _features("global") + "select msg_id, reply_chain_depth from f",
    "positions_global": _features("global") + "select msg_id, position from f",
    "ghosted_global": _features("global") + "select msg_id, ghosted from f",
    "context_windows_global": _windows_sql("global") + "select msg_id, context, reply, recipient_name, since timedelta_prev, position, reply_chain_depth from c",
    "clean_buckets": f"select * from (select msg_id, {_BUCKETS_CLEAN} as text from (select distinct msg_id, text from parsed)) where text is not null",
    "clean_lists": f"select * from (select msg_id, {_LISTS_CLEAN} as text from (select distinct msg_id, text from parsed), (select list(distinct lower(trim(word))) listed from nsfw_words where trim(word) <> '')) where text is not null",
    "stage_file": f"with {_M} select msg_id, datetime, sender, text from m",
    "split_files": f"with {_RECORDS} select text, split from r where text is not null",
    "split_file_lines": f"with {_RECORDS} select split, count(*) n_lines from r where text is not null group by 1",
    "reply_depth_events": _features("chat", _EVENTS, "event_id") + "select event_id, timedelta_prev, session_id, position, reply_chain_depth, ghosted from f",
    "ghosted_chat": _features("chat") + "select msg_id, ghosted from f",
    "conversation_id": "select source_file, left(md5(source_file), 8) conversation_id from (select distinct source_file from enriched)",
    "message_features": f"with {_M}, t as (select msg_id, text, length(text) n, case when text is null then null else len({_tokens('text')}) end w from m) select msg_id, n message_length, w word_count, ends_with({_g('text', rf'[{WS}]+$', '')}, '...') ends_ellipsis, ends_with({_g('text', rf'[{WS}]+$', '')}, '?') ends_question, regexp_matches(text, '(^|[^{W}])[A-Z]{{2,}}($|[^{W}])') has_caps_word, w = 1 is_single_word, n <= 3 is_very_short from t",
    "emoji_features": f"with {_M}, t as (select msg_id, len(regexp_extract_all(text, '{message.EMOJI}')) emoji_count from m) select *, emoji_count > 0 has_emoji from t",
    "clean_pii": f"select doc_id, {_pii('text')} cleaned from documents",
    "clean_urls": f"select doc_id, {_g('text', clean.URL, '[URL]')} cleaned from documents",
    "clean_devanagari": f"select doc_id, {_space(_g('text', clean.DEVANAGARI, ''))} cleaned from documents",
    "clean_english": f"select doc_id, {_without_english('text')} cleaned from documents",
    "clean_wordlist_filter": f"select doc_id, {_masked('text', '[WORD]')} cleaned from documents",
    "clean_full": f"with {_M} select * from (select msg_id, {_FULL_CLEAN} as text from m) where text is not null",
    "clean_preview_diff": f"with {_M}, p as (select *, {_PLAIN_CLEAN} cleaned from m), q as (select *, text is distinct from cleaned changed from p) select msg_id, {_redact('text', 24)} as before, coalesce({_redact('cleaned', 24)}, '[DROPPED]') as after, changed from q where datetime is not null and (changed or not (select bool_or(changed) from q)) order by datetime desc, msg_id desc limit 20",
    "clean_effect": f"with {_M}, p as (select text, {_PLAIN_CLEAN} cleaned from m) select count(*) n_rows, count(*) filter (text is distinct from cleaned) n_changed, count(*) filter (cleaned is null) n_dropped from p",
    "tag_relationships": f"""with {_M},
b as (select lower({_strip('name')}) name, phone, coalesce(relationship, 'acquaintance') rel, row_number() over (order by phone, name) o from contacts where name is not null),
k as (select name, min(o) o, arg_max(phone, o) phone, arg_max(rel, o) rel from b where name <> '' group by name),
p as (select distinct sender, source_file, case when coalesce(sender = '{YOU}', true) then '' else {_strip('lower(sender)')} end s, {_strip("lower(coalesce(source_file, ''))")} f from m),
g as (select *, case when contains(lower(coalesce(source_file, '')), 'group') then 'group_close' when contains(lower(coalesce(source_file, '')), 'gang') then 'group_formal' end grp from p),
h as (select g.sender, g.source_file, k.phone, k.rel, case when s <> '' and k.name = s then 1 when s <> '' and (contains(s, k.name) or contains(k.name, s)) then 2 when f <> '' and k.name = f then 3 else 4 end rk, k.o
 from g join k on grp is null and ((s <> '' and (contains(s, k.name) or contains(k.name, s))) or (f <> '' and (contains(f, k.name) or contains(k.name, f))))),
best as (select sender, source_file, arg_min(phone, rk * 1000000 + o) phone, arg_min(rel, rk * 1000000 + o) rel from h group by all)
select m.msg_id, case when g.grp is not null then 'group' else coalesce(best.phone, 'unknown') end recipient_phone, coalesce(g.grp, best.rel, 'acquaintance') relationship
from m join g on m.sender is not distinct from g.sender and m.source_file is not distinct from g.source_file left join best on m.sender is not distinct from best.sender and m.source_file is not distinct from best.source_file""",
    "dedup_messages": "select msg_id, datetime, sender, text from (select *, row_number() over (partition by datetime, sender, text order by source_file nulls first, line_no, msg_id) r from enriched) where r = 1",
    "date_cutoff": f"with {_M} select msg_id, datetime from m where datetime >= timestamp '{AS_OF}' - interval {30 * MONTHS} days",
    "stratified_split_counts": _SPLIT + "select * from (select relationship, 'test' split, te n from k union all select relationship, 'val', va from k union all select relationship, 'train', n - te - va from k) where n > 0",
    "size_verdict": _SPLIT + "select cast(sum(n) as bigint) n_samples, case when sum(n) < 3000 then 'small' when sum(n) < 8000 then 'usable' else 'good' end verdict from n",
    "stats_parsed": f"with {_M} select count(*) n_messages, cast(min(datetime) as date) first_day, cast(max(datetime) as date) last_day, count(distinct source_file) n_chats, count(*) filter (is_media) n_media from m",
    "stats_you": f"with {_M} select count(*) n_messages, round(avg(length(text)), 6) mean_length, round(avg(case when text is not null then len({_tokens('text')}) end), 6) mean_words, count(*) filter (len(regexp_extract_all(text, '{message.EMOJI}')) > 0) n_emoji from m where you",
    "by_relationship_bar": f"with {_M}, c as (select relationship, count(*) n_messages from m group by 1) select *, repeat('█', cast(floor(n_messages * 30 / (select max(n_messages) from c)) as int)) bar from c",
    "top_hours": f"with {_M}, c as (select cast(hour(datetime) as int) h, count(*) n_messages from m where datetime is not null group by 1) select h as hour, (case when h % 12 = 0 then 12 else h % 12 end) || case when h < 12 then ' AM' else ' PM' end as label, n_messages from c order by n_messages desc, h limit 5",
    "top_senders_pct": f"with {_M} select sender, count(*) n_messages, round(count(*) * 100.0::double / (select count(*) from m), 6) percent from m group by 1 order by 2 desc, 1 nulls first limit 8",
    "candidate_names": f"with {_M} select sender, count(*) n_messages from m where {_strip('sender')} <> '' group by 1 order by 2 desc, 1 limit 5",
    "recent_messages": f"with {_M} select msg_id, strftime(datetime, '%d %b %H:%M') shown_at, left(sender, 20) sender, left(coalesce({_redact('text', 24)}, '[DROPPED]'), 60) preview from m where datetime is not null order by datetime desc, msg_id desc limit 25",
    "parse_roundtrip": _PARSED,
    "export_files": f"select source_file, datetime, sender, text, is_media from ({_PARSED}) qualify row_number() over (partition by datetime, sender, text order by source_file, msg_id) = 1",
    "parse_timestamps": f"select event_id, {_MIN} dmy4, {_SWAPPED} mdy4, {_MIN} dmy2, {_SWAPPED} mdy2 from events",
    "system_filter": f"with {_M} select msg_id, {_MEDIA} is_media from m where not ({_MARKED}) and {_strip("coalesce(sender, '')")} not in ('', '~')",
    "chatml_extract": f"with {_RECORDS} select sample_id, {_USER} as context, {_REPLY} reply, {_PREFIX} as prompt from r where text is not null",
    "eval_previews": f"with {_RECORDS}, e as (select * from r where split = 'test' and text is not null order by sample_id limit 50), u as (select sample_id, {_USER} c, {_REPLY} t from e) select row_number() over (order by sample_id) - 1 as id, sample_id, {_redact('c', 12)} context_preview, {_redact('t', 12)} true_preview from u where c <> ''",
    "eval_last_context": f"with {_RECORDS}, u as (select sample_id, {_USER} c from r where text is not null), l as (select *, string_split(c, chr(10)) l from u) select sample_id, left(case when len(l) < 2 then c when starts_with(l[-2], '[') then coalesce(l[-3], '...') else l[-2] end, 70) last_line from l",
    "eval_summary": f"""with x as (select distinct sample_id, reply, context from contexts), p as (select coalesce(reply, '') t, coalesce(nullif(string_split(context, chr(10))[-1], ''), reply, '') g from x),
s as (select count(*) n, sum(length(t)) / greatest(count(*), 1)::double tl, sum(length(g)) / greatest(count(*), 1)::double gl, count(*) filter (regexp_matches(t, '{message.EMOJI_SIGN}')) / greatest(count(*), 1)::double te, count(*) filter (regexp_matches(g, '{message.EMOJI_SIGN}')) / greatest(count(*), 1)::double ge from p)
select n n_samples, round(tl, 6) true_length, round(gl, 6) generated_length, round(te, 6) true_emoji_rate, round(ge, 6) generated_emoji_rate, round(gl / greatest(tl, 1.0::double), 6) length_ratio, gl / greatest(tl, 1.0::double) between 0.6 and 1.6 in_band from s""",
    "split_lines": f"with {_RECORDS} select split, count(*) n_lines from r group by 1",
    "jsonl_roundtrip": f"with {_RECORDS} select sample_id, text from r",
}
