"""Rule tables.

The values in this module are fixed values: results only agree with the
catalogs being migrated when they are exactly these. They are data; every
operator that uses one accepts another table in its place.
"""

from __future__ import annotations

# -- Fixed values: source classification -------------------------------------
# (source, media_type or *, content_format prefix or *, surface, presentation,
#  origin, country, confidence, adult)
#   surface  "by_type"       -> series when media_type is anime, else movie
#   origin   "variety_check" -> variety when a keyword matches, else drama
#   country  "detail:XX"     -> country named in detail, else XX
#   adult    "by_label"      -> decided by the genre labels
SOURCE_RULES = [
    ("samehadaku", "movie", "*", "movie", "animation", "anime", "JP", 90, "by_label"),
    ("samehadaku", "*", "*", "series", "animation", "anime", "JP", 95, "by_label"),
    ("anichin", "*", "*", "series", "animation", "donghua", "CN", 98, "by_label"),
    ("drakorid", "movie", "*", "movie", "live_action", "movie", "detail:KR", 94, "by_label"),
    ("drakorid", "*", "*", "series", "live_action", "variety_check", "detail:KR", 94, "by_label"),
    ("manhwaindo", "*", "*", "comic", "illustrated", "manhwa", "KR", 92, "by_label"),
    ("kanzenin", "*", "*", "comic", "illustrated", "manga", "JP", 92, "true"),
    ("mangasusuku", "*", "*", "comic", "illustrated", "manga", "JP", 92, "true"),
    ("nekopoi", "*", "animation", "by_type", "animation", "anime", "JP", 88, "true"),
    ("nekopoi", "*", "*", "movie", "live_action", "movie", "JP", 88, "true"),
    ("hanime", "*", "*", "by_type", "animation", "anime", "JP", 94, "true"),
]
RULE_TAXONOMY_SOURCE = "provider_heuristic"
FALLBACK_TAXONOMY_SOURCE = "legacy_fallback"
FALLBACK_CONFIDENCE = 20

# media_type -> (surface, presentation, origin)
TYPE_RULES = {
    "movie": ("movie", "live_action", "movie"),
    "anime": ("series", "animation", "anime"),
    "donghua": ("series", "animation", "donghua"),
    "drama": ("series", "live_action", "drama"),
    "manga": ("comic", "illustrated", "manga"),
    "manhwa": ("comic", "illustrated", "manhwa"),
    "manhua": ("comic", "illustrated", "manhua"),
    "komiku": ("comic", "illustrated", "manga"),
}

# -- Fixed values: countries and time zones ----------------------------------
COUNTRY_SYNONYMS = {
    "JP": "JP", "JAPAN": "JP",
    "CN": "CN", "CHINA": "CN", "CHINESE": "CN",
    "KR": "KR", "KOREA": "KR", "SOUTH KOREA": "KR", "KOREAN": "KR",
    "US": "US", "USA": "US", "UNITED STATES": "US",
}
COUNTRY_BY_ORIGIN = {
    "anime": "JP", "manga": "JP", "donghua": "CN", "manhua": "CN", "drama": "KR", "manhwa": "KR",
}
TIMEZONE_BY_COUNTRY = {
    "JP": "Asia/Tokyo", "CN": "Asia/Shanghai", "KR": "Asia/Seoul", "US": "America/New_York",
}
COUNTRY_NAME_BY_LANGUAGE = {"ko": "South Korea", "ja": "Japan", "zh": "China"}

# -- Fixed values: JSON keys read from `detail`, in order of preference -------
LABEL_KEYS = ["genres", "genre_names", "tags", "tag_names"]
COUNTRY_KEYS = ["release_country", "country", "country_code", "origin_country"]
DAY_KEYS = ["release_day", "schedule_day", "broadcast_day", "day_of_week", "weekday", "runtime", "aired"]
WINDOW_KEYS = ["release_window", "broadcast_time", "release_time"]
TIMEZONE_KEYS = ["release_timezone", "timezone"]
STATUS_KEYS = ["status", "status_label", "airing_status"]
VARIETY_TEXT_KEYS = ["source_title", "title", "alt_title", "native_title", "format", "episodes_text"]
VARIETY_LIST_KEYS = ["categories", "category_names", "genres", "genre_names", "tags", "tag_names"]

# -- Fixed values: keyword lists ----------------------------------------------
ADULT_LABELS = ["nsfw", "adult", "18+", "hentai", "smut", "ecchi"]
VARIETY_KEYWORDS = [
    "variety", "reality", "talk show", "dating show", "dating reality", "entertainment show",
    "competition show", "game show", "music show", "idol show", "travel show",
    "running man", "how do you play", "1 night 2 days", "knowing brother", "my ugly duckling",
    "moms diary", "mom's diary", "the genius paik", "the return of superman", "superman returns",
    "whenever possible", "i live alone", "when our kids fall in love", "singles inferno",
]

# -- Fixed values: schedule ----------------------------------------------------
WEEKDAYS = {
    "monday": "monday", "senin": "monday",
    "tuesday": "tuesday", "selasa": "tuesday",
    "wednesday": "wednesday", "rabu": "wednesday",
    "thursday": "thursday", "kamis": "thursday",
    "friday": "friday", "jumat": "friday", "jum'at": "friday",
    "saturday": "saturday", "sabtu": "saturday",
    "sunday": "sunday", "minggu": "sunday",
}
WEEKDAY_ORDER = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
COMPLETED_STATUSES = ["completed", "finished", "finished airing"]
AIRING_STATUSES = ["ongoing", "airing", "currently airing"]
CADENCES = ["daily", "weekly", "biweekly", "monthly", "irregular", "completed", "unknown"]
# (source, media_type or *) whose airing series are weekly
WEEKLY_RULES = [("samehadaku", "*"), ("anichin", "*"), ("drakorid", "drama")]

# -- Fixed values: promotion locks (source, media_type or *, origin or *) ------
LOCK_RULES = [
    ("anichin", "*", "*"),
    ("samehadaku", "anime", "*"),
    ("drakorid", "movie", "*"),
    ("drakorid", "*", "variety"),
]
PROMOTION_CONFIDENCE_CAP = 90
PROMOTION_SOURCE = "anilist_promotion"
PROMOTION_DETAIL_KEYS = {
    "title_english": "anilist_title_english",
    "title_romaji": "anilist_title_romaji",
    "title_native": "anilist_title_native",
    "description": "anilist_description",
    "banner_image": "anilist_banner_url",
    "site_url": "anilist_site_url",
    "format": "anilist_format",
    "status": "anilist_status",
}

# -- Fixed values: title score profiles ----------------------------------------
# exact, contains, minimum shared tokens, base for shared tokens, year bonuses,
# season bonus, accepted from, `|` counts as a separator
SCORE_PROFILES = {
    "A": dict(exact=100, contains=70, min_shared=2, shared_base=40, year_same=20, year_near=5, season=0,
              accept=1, pipe_is_space=True),
    "B": dict(exact=100, contains=65, min_shared=2, shared_base=45, year_same=20, year_near=5, season=0,
              accept=70, pipe_is_space=True),
    "C": dict(exact=100, contains=70, min_shared=3, shared_base=40, year_same=0, year_near=0, season=15,
              accept=1, pipe_is_space=False),
}
SEASON_PHRASES = ["season 2", "season 3", "season 4", "2nd season", "3rd season", "4th season"]

# -- Fixed values: Jaccard stop lists and title clean-up phrases ---------------
STOP_TOKENS = {
    "1": ["subtitle", "indonesia", "sub", "indo", "episode", "lengkap"],
    "2": ["subtitle", "indonesia", "sub", "indo", "batch", "bd", "lengkap"],
}
CLEAN_TITLE = {
    "1": dict(suffix="| Otaku Desu", drop=["Subtitle Indonesia", "Sub Indo"], cut_at="(episode"),
    "2": dict(suffix="| Kusonime", drop=["Batch Subtitle Indonesia", "Subtitle Indonesia", "Sub Indo", "Batch", "BD"],
              cut_at=None),
}
YEAR_SUFFIX_PATTERN = r"\s*\((19|20)\d{2}\)\s*$"
DRAMA_PREFIX_PATTERN = r"^(?i:drama\s+(korea|china|jepang|japan)\s+)"
EPISODE_SUFFIX_PATTERN = r"(?i)\s+episode\s+\d+(?:\.\d+)?$"

# -- Fixed values: query aliases (JSON paths into detail; "@title" = the title;
#    a trailing [] reads a list) -------------------------------------------------
ALIASES_PRIMARY = [
    "search_hit.title_english", "jikan_meta_json.search_hit.title_english",
    "search_hit.title", "jikan_meta_json.search_hit.title",
    "jikan_meta_json.anime_full.title_english", "jikan_meta_json.anime_full.title",
    "source_title", "@title",
    "search_hit.title_synonyms[]", "jikan_meta_json.search_hit.title_synonyms[]",
    "jikan_meta_json.anime_full.title_synonyms[]", "alt_title",
]
ALIASES_FALLBACK = [
    "jikan_meta_json.search_hit.title_english", "jikan_meta_json.search_hit.title",
    "source_title", "alt_title", "native_title", "@title", "jikan_meta_json.search_hit.title_synonyms[]",
]
# Sources whose titles carry a drama prefix, need ASCII letters, and add native_title.
ASCII_TITLE_SOURCES = ["drakorid"]

# -- Fixed values: code tables (code, match kind, values); first match wins -----
CODE_TABLES = {
    "anime_type": ([("t", "eq", ["tv"]), ("m", "eq", ["movie"]), ("o", "eq", ["ova"]), ("n", "eq", ["ona"]),
                    ("p", "eq", ["special"])], "u"),
    "anime_status": ([("a", "eq", ["ongoing", "currently airing", "airing"]),
                      ("f", "eq", ["completed", "finished airing"]), ("u", "like", ["upcoming"])], "x"),
    "season": ([("w", "eq", ["winter"]), ("p", "eq", ["spring"]), ("s", "eq", ["summer"]),
                ("f", "eq", ["fall", "autumn"])], "x"),
    "movie_quality": ([("b", "like", ["bluray"]), ("w", "like", ["web"]), ("d", "like", ["dvd"]),
                       ("h", "eq", ["1080p", "720p", "fullhd", "mp4hd"]), ("m", "eq", ["480p"]),
                       ("l", "eq", ["360p"])], "u"),
    "movie_status": ([("r", "eq", ["released", "returning series"]),
                      ("p", "eq", ["post production", "in production"]), ("u", "eq", ["planned", "rumored"])], "x"),
    "movie_format": ([("x", "like", ["x265", "h265", "hevc"]), ("m", "like", ["mp4"]), ("k", "like", ["mkv"])], "u"),
    "option_status": ([("a", "eq", ["active", "ready", "verified"]), ("b", "like", ["block"]),
                       ("d", "like", ["dead", "removed"])], "x"),
}
# code -> label, for the read views
CODE_LABELS = {
    "anime_type": {"t": "TV", "m": "Movie", "o": "OVA", "n": "ONA", "p": "Special"},
    "anime_status": {"a": "Ongoing", "f": "Completed", "u": "Upcoming"},
    "season": {"w": "Winter", "p": "Spring", "s": "Summer", "f": "Fall"},
    "fetch_status": {"p": "primary", "s": "secondary", "b": "blocked", "x": "unknown"},
}

# -- Fixed values: dates ---------------------------------------------------------
MONTHS_EN = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
             "november", "december"]
MONTHS_ID = ["januari", "februari", "maret", "april", "mei", "juni", "juli", "agustus", "september", "oktober",
             "november", "desember"]

# -- Fixed values: reading sources -----------------------------------------------
READING_SOURCES = ["bacaman", "mangasusuku", "kanzenin", "komiku", "manhwaindo"]
DEFAULT_READING_SOURCE = "manhwaindo"
MANDATED_TAG = {"kanzenin": "nsfw", "mangasusuku": "nsfw"}
DEFAULT_READING_TYPE = {"komiku": "komiku"}
FALLBACK_READING_TYPE = "manhwa"

# -- Fixed values: formats, credits and paragraphs ----------------------------------
FORMAT_BY_CATEGORY = [
    ("live_action", ["jav", "live action"]),
    ("animation_2d", ["2d animation", "2d hentai", "l2d"]),
    ("animation_3d", ["3d hentai", "3d animation"]),
]
FORMAT_BY_TITLE = [("live_action", ["live action"]), ("animation_3d", ["[3d]"]), ("animation_2d", ["[l2d]", "[2d]"])]
DEFAULT_FORMAT = "live_action"
CREDIT_LINE_PREFIXES = ["subtitle :", "lirik ", "retiming ", "sumber video", "download "]
POSTER_BASE = "https://image.tmdb.org/t/p/w500"
VIDEO_BASE = "https://www.youtube.com/watch?v="

# -- Fixed values: fetch outcomes (primary, secondary or *) -> overall ----------------
FETCH_OUTCOMES = [
    ("fetched", "not_attempted", "primary_fetched"),
    ("fetched", "fetched", "primary_fetched_secondary_fetched"),
    ("challenge_blocked", "fetched", "primary_challenge_blocked_secondary_fetched"),
    ("redirected_offsite", "fetched", "primary_redirected_offsite_secondary_fetched"),
    ("fetch_failed", "fetched", "primary_fetch_failed_secondary_fetched"),
    ("challenge_blocked", "fetch_failed", "primary_challenge_blocked_secondary_failed"),
    ("challenge_blocked", "not_attempted", "primary_challenge_blocked"),
    ("redirected_offsite", "not_attempted", "primary_redirected_offsite"),
    ("fetch_failed", "not_attempted", "primary_fetch_failed"),
    ("empty", "fetched", "primary_empty_secondary_fetched"),
    ("empty", "not_attempted", "primary_empty"),
]

# -- Fixed values: patch domains ------------------------------------------------------
# (domain or "@source", source list or *, media types or *, unit type or *)
DOMAIN_RULES = [
    ("anime", ["samehadaku"], ["anime"], "episode"),
    ("movie", "*", ["movie"], "*"),
    ("@source", ["manhwaindo", "komiku"], "*", "chapter"),
    ("donghua", "*", ["donghua"], "episode"),
]

# -- Fixed values: thresholds ------------------------------------------------------------
LOOKBACK_MINUTES = 45
TARGETS_PER_DOMAIN = 8
FRESH_HOURS, STALE_HOURS = 4, 8
REVIEW_BELOW = 0.8
MIN_MATCH = {"1": 0.55, "2": 0.60}
SEARCH_MIN_CHARS, SEARCH_LIMIT, SEARCH_MAX = 2, 8, 20
EPISODE_ITEM_TYPE = "anime"

# -- Fixed values: adaptation annotations (slug contains, title contains) -----------------
ADAPTATION_RULE = dict(slug_contains="live-action", title_contains="live action",
                       adaptation_type="live_action", entry_format="series")
ENTRY_FORMAT_OVERRIDES = {"kaguya-sama-wa-kokurasetai-first-kiss-wa-owaranai": "special_series"}
LEGACY_SLUG_MARK = "subtitle-indonesia"
