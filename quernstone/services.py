"""Answers to commands over the index: each is one row (mode, text, image)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions.rules import strip
from .operators import index as ix
from .operators import render
from .operators.postings import StoredIndex

# Commands and what they ask for.
COMMANDS = {"角色": "角色", "歌曲": "歌曲", "乐队": "乐队", "声优": "声优"}
RANDOM_COMMANDS = {"随机角色": ("角色", 1200), "随机歌曲": ("歌曲", 600), "随机声优": ("声优", 1200)}
SEARCH_COMMAND, HELP_COMMAND = "萌百搜索", "bandori"
NOT_READY = "知识库未加载"


Index = DataFrame | StoredIndex


def _row(index: Index, mode: str, text: str) -> DataFrame:
    return index.sparkSession.range(1).select(F.lit(mode).alias("mode"), F.lit(text).alias("text"), F.lit("").alias("image"))  # no Python for a fixed row


def entry_query(index: Index, name: str, bucket: str) -> DataFrame:
    """The best entry's card if its score is high enough, else a list, else a sentence; help for a blank name.

    Card and list are aggregates of the same results, so the index is searched once.
    """
    if not name.strip():
        return _row(index, "help", render.HELP)
    results = ix.search(index, name, bucket, 5)
    best = F.struct(
        F.when(F.col("score") >= ix.DETAIL_SCORE, "detail").otherwise("list").alias("mode"),
        render.detail_card(F.col("title"), F.col("category_dir"), F.col("content")).alias("card"),
        "image",
    )
    out = results.agg(render.list_text(name, bucket).alias("listed"), F.max(F.when(F.col("rank") == 1, best)).alias("best"))
    mode = F.col("best.mode")
    return out.select(
        F.coalesce(mode, F.lit("none")).alias("mode"),
        F.when(mode == "detail", F.col("best.card")).when(mode == "list", F.col("listed")).otherwise(render.not_found_text(name, bucket)).alias("text"),
        F.when(mode == "detail", F.col("best.image")).otherwise("").alias("image"),
    )


def search_query(index: Index, keyword: str) -> DataFrame:
    """A list over all buckets, eight at most."""
    if not keyword.strip():
        return _row(index, "help", render.HELP)
    out = render.result_list(ix.search(index, keyword, limit=8), keyword)
    return out.select(F.lit("list").alias("mode"), "text", F.lit("").alias("image"))


def random_query(index: Index, bucket: str, chars: int = 1200, seed: int | None = None) -> DataFrame:
    """A random entry's card, or that the bucket is empty."""
    pick = ix.random_pick(index, bucket, seed).select(render.random_card(F.col("title"), F.col("category_dir"), F.substring("content", 1, chars)).alias("card"), "image")
    empty = _row(index, "error", render.error_text(f"{bucket}库为空"))
    out = empty.join(pick.withColumnRenamed("image", "own"), F.lit(True), "left")  # one row, and one or none
    return out.select(F.when(F.col("card").isNotNull(), "random").otherwise(F.col("mode")).alias("mode"), F.coalesce("card", "text").alias("text"), F.coalesce("own", "image").alias("image"))


def messages(answers: DataFrame, images: DataFrame) -> DataFrame:
    """Answers (mode, text, image) as messages (text, image, is_plain): an image that is not among ``images`` (path) leaves plain text."""
    there = images.select(F.col("path").alias("image")).distinct().withColumn("there", F.lit(True))
    out = answers.join(there, "image", "left").withColumn("image", F.when(F.col("there"), F.col("image")).otherwise(""))
    return out.select("mode", "text", "image", (F.col("image") == "").alias("is_plain"))


def dispatch(message: Column) -> Column:
    """What a chat message asks for: (command, kind, bucket, argument).

    Kinds are entry, search, random and help; the longest command that the
    message begins with counts, whatever follows it is the argument. Blank
    arguments of entry and search ask for help, and so do unknown commands;
    nulls are blank.
    """
    text = F.regexp_replace(strip(F.coalesce(message, F.lit(""))), "^/", "")
    out = F.struct(F.lit("").alias("command"), F.lit("help").alias("kind"), F.lit("").alias("bucket"), F.lit("").alias("argument"))
    for command in sorted([*COMMANDS, *RANDOM_COMMANDS, SEARCH_COMMAND, HELP_COMMAND], key=len):
        rest = strip(F.substring(text, F.lit(len(command) + 1), F.length(text)))
        if command in RANDOM_COMMANDS:
            kind, bucket = F.lit("random"), RANDOM_COMMANDS[command][0]
        elif command == HELP_COMMAND:
            kind, bucket = F.lit("help"), ""
        else:
            kind, bucket = F.when(rest == "", "help").otherwise("search" if command == SEARCH_COMMAND else "entry"), COMMANDS.get(command, "")
        asked = F.struct(F.lit(command).alias("command"), kind.alias("kind"), F.lit(bucket).alias("bucket"), rest.alias("argument"))
        out = F.when(F.startswith(text, F.lit(command)), asked).otherwise(out)
    return out


class Engine:
    """``ask`` takes a chat message and gives an answer."""

    def __init__(self, index: Index | None):
        self.index = index

    def reload(self, index: Index) -> None:
        self.index = index

    def ask(self, message: str, seed: int | None = None) -> tuple[str, str, str]:
        """(mode, text, image) for a command such as ``/角色 名字``; unknown commands are help."""
        if self.index is None:
            return "error", render.error_text(NOT_READY), ""
        text = message.strip().removeprefix("/")
        for command in sorted([*COMMANDS, *RANDOM_COMMANDS, SEARCH_COMMAND, HELP_COMMAND], key=len, reverse=True):
            if text.startswith(command):
                rest = text[len(command) :].strip()
                if command in RANDOM_COMMANDS:
                    out = random_query(self.index, *RANDOM_COMMANDS[command], seed=seed)
                elif command in COMMANDS:
                    out = entry_query(self.index, rest, COMMANDS[command])
                elif command == SEARCH_COMMAND:
                    out = search_query(self.index, rest)
                else:
                    break
                return tuple(out.first())
        return "help", render.HELP, ""
