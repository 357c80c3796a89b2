"""Images of pages by API: a chain of requests, each hop asking only for what the hop before left open.

1. ``pageimages`` names the page's own image.
2. Else ``images`` lists the images of the page; the first three are looked at,
   those that are no pictures left out.
3. ``imageinfo`` gives the address of one of them: the first whose answer
   comes decides, a request that fails leaves it to the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..sources.files import IMAGES_TRIED, is_picture
from ..storage import materialize
from .live import fetch_urls

#: What the three hops ask for, and the shapes of their answers: fixed values.
OWN, LISTED, INFO = ("?action=query&format=json&" + q + "&titles=" for q in ("prop=pageimages&piprop=original", "prop=images", "prop=imageinfo&iiprop=url"))
OWN_JSON = "struct<query:struct<pages:map<string,struct<original:struct<source:string>>>>>"
LISTED_JSON = "struct<query:struct<pages:map<string,struct<images:array<struct<title:string>>>>>>"
INFO_JSON = "struct<query:struct<pages:map<string,struct<imageinfo:array<struct<url:string>>>>>>"


def _pages(body: Column, shape: str) -> Column:
    return F.coalesce(F.map_values(F.from_json(body, shape)["query"]["pages"]), F.lit(None))


def own_image(body: Column) -> Column:
    """The address of the page's own image; null if there is none."""
    found = F.transform(_pages(body, OWN_JSON), lambda p: p["original"]["source"])
    return F.get(F.filter(found, lambda x: x.isNotNull() & (x != "")), F.lit(0))


def listed_images(body: Column) -> Column:
    """The images of a page that are asked for: of the first three those that are pictures."""
    found = F.transform(_pages(body, LISTED_JSON), lambda p: F.slice(F.coalesce(F.transform(p["images"], lambda i: i["title"]), F.array().cast("array<string>")), 1, IMAGES_TRIED))
    return F.filter(F.flatten(found), is_picture)


def image_address(body: Column) -> Column:
    """The address in an ``imageinfo`` answer; null if there is none."""
    found = F.transform(_pages(body, INFO_JSON), lambda p: F.get(p["imageinfo"], F.lit(0))["url"])
    return F.get(F.filter(found, lambda x: x.isNotNull() & (x != "")), F.lit(0))


def _asked(rows: DataFrame, what: str, title: Column, client: str, settings: Settings) -> DataFrame:
    """``rows`` with status and body of a request for each; equal requests are made once."""
    rows = rows.withColumn("url", F.concat(F.lit(settings.api_url + what), F.url_encode(title)))
    answers = fetch_urls(rows.select("url").distinct(), client, settings).select("url", "status", "body")
    return materialize(rows.join(answers, "url").drop("url"), "hop")


def find_images(titles: DataFrame, client: str, settings: Settings = Settings()) -> DataFrame:
    """(title, image, hop) of a table (title): the address of each page's image and the hop that found it; both null if none did.

    Repeated titles are looked up once. ``client`` is as in
    :func:`quernstone.plans.live.fetch_urls`.
    """
    first = _asked(titles.select("title").where("title IS NOT NULL").distinct(), OWN, F.col("title"), client, settings)
    first = first.select("title", F.when(F.col("status") == 200, own_image(F.col("body"))).alias("image"))
    found = first.where("image IS NOT NULL").select("title", "image", F.lit(1).alias("hop"))
    second = _asked(first.where("image IS NULL").select("title"), LISTED, F.col("title"), client, settings)
    still = second.where("status = 200").select("title", listed_images(F.col("body")).alias("names"))
    for k in range(IMAGES_TRIED):
        still = still.where(F.size("names") > k)
        third = _asked(still, INFO, F.get("names", F.lit(k)), client, settings)
        image = image_address(F.col("body"))
        found = found.unionByName(third.where("status = 200").select("title", image.alias("image"), F.lit(3).alias("hop")).where("image IS NOT NULL"))
        still = third.where("status <> 200").select("title", "names")
    return titles.select("title").distinct().join(found, "title", "left")
