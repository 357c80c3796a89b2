"""Settings of the engine. The literals are fixed values: results depend on them."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace

#: Namespace prefixes of pages that are no articles.
SKIP_PREFIXES = ("Category:", "Template:", "Module:", "File:", "Image:", "Special:", "Help:", "MediaWiki:", "User:")
#: Parts of titles of pages that are no articles.
SKIP_TITLE_WORDS = ("消歧义", "导航模板", "/模板", "模板:")
#: Patterns of such titles, in any case.
SKIP_TITLE_PATTERNS = (r"/\s*模板$", r"/\s*列表$")
#: Parts of categories of such pages.
SKIP_CATEGORY_WORDS = ("消歧义页", "导航模板", "维基百科模板", "草稿页", "沙盒", "帮助页面", "方针页", "指引页", "模板说明页", "文件说明页", "分类索引")
#: Patterns of such pages' first 500 characters, in any case.
SKIP_CONTENT_PATTERNS = (r"这是一个消歧义页", r"\{\{消歧义", r"\{\{disambig", r"\{\{navbox")
CONTENT_SAMPLE = 500
#: Reasons for leaving a page out.
REASON_PREFIX, REASON_WORD, REASON_PATTERN = "命名空间前缀: ", "标题关键字: ", "标题匹配正则"
REASON_CATEGORY, REASON_CONTENT, REASON_EMPTY, REASON_REDIRECT = "分类标签: ", "内容模式: ", "空页面", "重定向页"
REDIRECT = "Redirect to:"

#: Category word to directory, the first word that fits counts.
DIRECTORIES = (
    ("角色", "角色"),
    ("人物", "角色"),
    ("歌曲", "歌曲"),
    ("音乐", "歌曲"),
    ("乐队", "乐队"),
    ("组合", "乐队"),
    ("动画", "动画"),
    ("动漫", "动画"),
    ("专辑", "专辑"),
    ("Live", "Live"),
    ("演唱会", "Live"),
    ("游戏", "其它"),
    ("漫画", "其它"),
    ("活动", "其它"),
    ("学校", "其它"),
    ("术语", "其它"),
)
OTHER = "其它"

#: Directories that the index scans, in order, and the buckets of the index.
INDEX_DIRS = ("角色", "歌曲", "乐队", "其它", "声优", "动画", "Live")
BUCKETS = ("角色", "歌曲", "乐队", "声优", "其它")
OWN_BUCKET = ("角色", "歌曲", "乐队", "声优")
#: Image folders of the buckets and extensions, in order.
IMAGE_DIRS = {"角色": ("images/character", "images/角色"), "歌曲": ("images/song", "images/歌曲"), "乐队": ("images/band", "images/乐队"), "声优": ("images/声优",)}
IMAGE_EXTENSIONS = (".jpg", ".png", ".webp")

#: The marker of categories that name a voice actor, and the actors' directory.
ACTOR_MARK, ACTOR_DIR = "配音角色", "声优"

BASE_URL = "https://zh.moegirl.org.cn"


@dataclass(frozen=True)
class Settings:
    """What a run may change."""

    base_url: str = BASE_URL
    api_url: str = BASE_URL + "/api.php"
    root_category: str = "Category:BanG Dream!"
    max_depth: int = 10
    split_threshold: int = 5000
    rate_limit: float = 0.5
    jitter: float = 0.5
    max_concurrent: int = 3
    attempts: int = 5
    first_wait: float = 1.0
    longest_wait: float = 60.0
    retry_jitter: float = 2.0
    fetch_batch: int = 50
    titles_per_request: int = 20
    output_dir: str = "output"
    cache_dir: str = "cache"
    http2: bool = True
    log_level: str = "INFO"
    strict: bool = True
    directories: tuple[tuple[str, str], ...] = field(default=DIRECTORIES)


#: Environment variables and the settings that they override.
ENVIRONMENT = {
    "KB_RATE_LIMIT": "rate_limit",
    "KB_MAX_CONCURRENT": "max_concurrent",
    "KB_CACHE_DIR": "cache_dir",
    "KB_OUTPUT_DIR": "output_dir",
    "KB_ROOT_CATEGORY": "root_category",
    "KB_HTTP2": "http2",
    "KB_LOG_LEVEL": "log_level",
}


def from_env(environ: dict[str, str] | None = None) -> Settings:
    """Settings with the overrides of the environment; booleans are true, 1 or yes in any case."""
    environ = os.environ if environ is None else environ
    settings, changes = Settings(), {}
    for name, key in ENVIRONMENT.items():
        if environ.get(name):
            old, text = getattr(settings, key), environ[name]
            changes[key] = text.lower() in ("true", "1", "yes") if isinstance(old, bool) else type(old)(text)
    if "log_level" in changes:
        changes["log_level"] = changes["log_level"].upper()
    return replace(settings, **changes)


def resolve_kb_path(configured: str = "", environ: dict[str, str] | None = None, beside: str = "", exists=os.path.isdir) -> str:
    """The first folder that exists of: configured, KB_PATH, ``output`` beside the program, ``output`` here; empty if none."""
    environ = os.environ if environ is None else environ
    for path in (configured, environ.get("KB_PATH", ""), os.path.join(beside, "output") if beside else "", os.path.join(os.getcwd(), "output")):
        if path and exists(path):
            return path
    return ""
