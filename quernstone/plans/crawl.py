"""The full crawl and the incremental update as DataFrame jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import names
from ..functions.wikitext import parse_markdown
from ..operators import filters, graph, merge, render, stats
from ..storage import materialize

PAGE_COLUMNS = ("title", "page_id", "revision_id", "updated", "categories", "wikitext", "markdown", "url", "redirect_target", "status", "error")


@dataclass
class Crawl:
    """What a run makes: the page table, the files, the index document and the counters."""

    pages: DataFrame
    files: DataFrame
    index: DataFrame
    counters: DataFrame


def process(fetched: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Fetched pages (title, page_id, revision_id, updated, categories, wikitext, url, redirect_target) tagged and parsed.

    Pages that are filtered stay with status ``skipped`` and no Markdown.
    Narrow: a scan's worth of work, no shuffle.
    """
    tagged = filters.tag_pages(fetched)
    kept = F.col("status") == "completed"
    out = tagged.withColumn("markdown", F.when(kept, parse_markdown(F.col("wikitext"), settings.strict))).withColumn("error", F.lit(None).cast("string"))
    return out.withColumn("display_title", names.display_title(F.col("title")))


def outputs(pages: DataFrame, settings: Settings = Settings()) -> Crawl:
    done = pages.where("status = 'completed'")
    files = render.render_files(done, settings.split_threshold, settings.output_dir)
    return Crawl(pages, files, render.index_json(done), stats.run_counters(pages))


def crawl(edges: DataFrame, fetched: DataFrame, settings: Settings = Settings()) -> Crawl:
    """Discover, join what was fetched, filter, parse, split, render.

    ``fetched`` may be any source of pages by title, such as
    :func:`quernstone.sources.api.pages_from_json`. In strict mode several
    discovered aliases of one page stay several rows.
    """
    found = graph.discover(edges, settings.root_category, settings.max_depth).where("page_type = 'page'")
    pages = found.select("title").join(fetched, "title")
    return outputs(materialize(process(pages, settings), "pages"), settings)


def update(cached: DataFrame, fresh: DataFrame, now: Column, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """(the merged page table, actions by title) of an incremental update.

    Only completed pages of the cache are looked at; pages that are missing
    or not newer stay as they are; filtered ones are stored as skipped. New
    pages are not discovered and none is deleted. An empty cache stays empty:
    the caller crawls in full then.
    """
    completed = cached.where("status = 'completed'")
    actions = merge.update_actions(completed.select("title", "revision_id"), fresh, filters.skip_reason(F.col("title"), F.col("categories"), F.col("wikitext"))).select("title", "action")
    actions = materialize(actions, "actions")
    changed = fresh.join(actions.where("action IN ('updated', 'filtered')").select("title"), "title", "left_semi")
    new = process(changed, settings)
    kinds = {f.name: f.dataType for f in cached.schema if f.name not in ("created_at", "updated_at")}
    new = new.select(*(F.col(c) if c in new.columns else F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()))
    return merge.upsert(cached, new, "title", now), actions


def action_counts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action").agg(F.count("*").alias("n_pages"))
