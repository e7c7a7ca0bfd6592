"""URL parts, rewrites and the crawl rules built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attestra.functions.columns import as_col, case, text_of
from attestra.functions.text import collapse, safe_file, split_lines, strip_space

# ---- fixed values: hosts and paths ---------------------------------------------------------------
HUB_HOSTS = ("molecule.xyz", "mint.molecule.to")
HUB_BLOCKED_HOSTS = ("docs.molecule.xyz", "labs.molecule.xyz", "molecule.xyz", "mint.molecule.to")
FOOTER_HOSTS = ("peptai.xyz", "bio.xyz", "biofy.xyz", "ai.bio.xyz", "desci.codes")
FOOTER_URLS = ("https://github.com/moleculeprotocol", "https://drive.google.com/drive/folders/1MBSVsumY2qfLNU9-pRERr5eq2f_ogjs8", "https://snapshot.box")
EXPLORER_HOSTS = ("etherscan.io", "basescan.org", "arbiscan.io", "polygonscan.com")
SOCIAL_HOSTS = (
    "t.me", "telegram.me", "telegram.dog", "twitter.com", "x.com", "mobile.twitter.com", "nitter.net", "t.co", "discord.com", "discord.gg",
    "instagram.com", "facebook.com", "fb.com", "linkedin.com", "youtube.com", "youtu.be", "reddit.com", "threads.net", "tiktok.com",
)
MIRRORED_HOSTS = ("x.com", "twitter.com", "mobile.x.com", "mobile.twitter.com")
BLOCKED_PATHS = ("/discover", "/blog", "/resources", "/about", "/careers", "/app", "/brand")
BLOCKED_ANCHORS = (r"discover\s+projects?", r"^launch\s+app$", r"^connect$", r"^subscribe$", r"^sign\s+in$", r"^log\s+in$")
GATEWAYS = ("https://ipfs.io/ipfs/", "https://dweb.link/ipfs/", "https://gateway.pinata.cloud/ipfs/", "https://cloudflare-ipfs.com/ipfs/",
            "https://w3s.link/ipfs/", "https://4everland.io/ipfs/")
ERROR_PHRASES = ("page not found", "can't find the page", "cannot find the page")
SKIPPED_TITLES, PULLED_TITLES = ("dataApi",), ("downloadUrl", "tokenUri")
BOILERPLATE_LINES = (r"^\[Powered by GitBook\]", r"^Last updated ", r"^\[(Previous|Next)", r"^Copy\s*$", r"^`⌘Ctrl`", r"^On this page\s*$", r"^\[\]\(")


def url_host(url) -> Column:
    """Lower-case host without a leading www."""
    host = F.regexp_extract(F.trim(text_of(url)), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.regexp_replace(F.lower(host), r"^www\.", "")


def url_path(url) -> Column:
    return F.regexp_extract(F.trim(text_of(url)), r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_key(url) -> Column:
    return F.rtrim(as_col(url), F.lit("/"))


def site_name(url) -> Column:
    return F.when(is_ipfs(url), "ipfs").otherwise(F.nullif(url_host(url), F.lit("")))


def url_slug(url) -> Column:
    path = F.trim(url_path(url), F.lit("/"))
    return safe_file(F.replace(F.when(path == "", "index").otherwise(path), F.lit("/"), F.lit("__")), 80)


def project_id(url) -> Column:
    path = url_path(url)
    found = [F.nullif(F.regexp_extract(path, p, 1), F.lit("")) for p in (r"(?i)/ipnfts?/([^/?#]+)", r"(?i)/projects/([^/?#]+)")]
    return F.coalesce(*found)


def handle(url) -> Column:
    """Profile handle of a mirror URL; null for status, search and service paths."""
    path = F.trim(url_path(url), F.lit("/"))
    name = F.ltrim(F.substring_index(path, "/", 1), F.lit("@"))
    ok = (url_host(url) == "nitter.net") & (path != "") & ~F.concat(F.lit("/"), path).rlike(r"(?i)/status/\d+")
    return F.when(ok & ~path.rlike("^(search|hashtag)") & (name != "") & ~F.lower(name).isin("i", "intent", "share"), name)


def is_http(url) -> Column:
    return F.trim(text_of(url)).rlike("(?i)^https?://")


def is_ipfs(url, site=None) -> Column:
    own = F.trim(text_of(url)).rlike("(?i)^ipfs://")
    return own if site is None else own | (F.lower(text_of(site)) == "ipfs")


def is_explorer(url) -> Column:
    host = url_host(url)
    return host.isin(*EXPLORER_HOSTS) | host.rlike(r"\.(etherscan\.io|basescan\.org|arbiscan\.io|polygonscan\.com)$")


def is_social(url) -> Column:
    return url_host(url).isin(*SOCIAL_HOSTS)


def is_mirror(url) -> Column:
    return url_host(url) == "nitter.net"


# --- H10 rewrites ---------------------------------------------------------------------------------
def mirror_url(url) -> Column:
    """Social profile and status pages moved to the mirror host."""
    u = F.trim(as_col(url))
    moved = F.regexp_replace(u, r"(?i)^https?://(?:[^/?#@]*@)?[^/?#:]+", "https://nitter.net")
    moved = F.when(moved.rlike(r"^https://nitter\.net(:\d+)?$"), F.concat(moved, F.lit("/"))).otherwise(moved)
    return F.when(is_http(u) & url_host(u).isin(*MIRRORED_HOSTS), moved).otherwise(u)


def gateway_urls(url) -> Column:
    cid = F.regexp_replace(F.regexp_replace(F.trim(text_of(url)), r"(?i)^ipfs:///*", ""), "/+$", "")
    return F.when(is_ipfs(url) & (cid != ""), F.transform(F.array(*[F.lit(g) for g in GATEWAYS]), lambda g: F.concat(g, cid))).otherwise(
        F.array().cast("array<string>"))


def probe_url(url) -> Column:
    return F.coalesce(F.try_element_at(gateway_urls(url), F.lit(1)), F.trim(as_col(url)))


def catalog_to_page(url) -> Column:
    return F.when(url_host(url) == "molecule.xyz", F.concat(F.lit("https://mint.molecule.to/ipnft/"), project_id(url)))


def encode_path(url) -> Column:
    """Percent-encoded path of a PDF URL, scheme, host, query and fragment as they are."""
    u = F.trim(as_col(url))
    head = F.regexp_extract(u, r"(?i)^([a-z][a-z0-9+.-]*://[^/?#]*)", 1)
    rest = F.regexp_extract(u, r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*[^?#]*(.*)$", 1)
    parts = F.transform(F.split(url_path(u), "/"), lambda s: F.replace(F.replace(F.replace(F.url_encode(s), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")))
    return F.concat(head, F.array_join(parts, "/"), rest)


def page_url(base: str, kind: str, item_id, slug, default_slug: str | None = None) -> Column:
    s = F.trim(text_of(slug))
    if default_slug is not None:
        s = F.when(s == "", default_slug).otherwise(s)
    return F.concat(F.lit(f"{base}/{kind}/"), as_col(item_id).cast("string"), F.when(s != "", F.concat(F.lit("/"), s)).otherwise(""))


# --- P23..P29 -------------------------------------------------------------------------------------
def link_skip_reason(url, site=None, accessible=None) -> Column:
    u = F.trim(text_of(url))
    return case(
        (u == "", "empty_url"), (is_mirror(u), "nitter_deferred"), (is_ipfs(u, site), "ipfs_deferred"), (is_social(u), "social_deferred"),
        (is_explorer(u), "explorer_deferred"), (~is_http(u), "non_http"),
        (F.coalesce(as_col(accessible) == "no", F.lit(False)) if accessible is not None else F.lit(False), "inaccessible"))


def crawl_mode(url) -> Column:
    host = url_host(url)
    return case((host.isin(*HUB_HOSTS), "hub"), (host == "snapshot.box", "spa_single"),
                (F.contains(F.lower(as_col(url)), F.lit("doc")) | F.contains(host, F.lit("gitbook")), "docs_deep"), default="single")


def is_blocked_anchor(text) -> Column:
    t = F.trim(text_of(text))
    return F.array_contains(F.array(*[t.rlike("(?i)" + p) for p in BLOCKED_ANCHORS]), True)


def is_catalog_path(path) -> Column:
    p = F.rtrim(F.lower(as_col(path)), F.lit("/"))
    return p.rlike("^(" + "|".join(BLOCKED_PATHS) + ")") | (p == "/projects")


def follow_block_reason(url, seed) -> Column:
    """Why an outbound link is not followed; null when it may be."""
    host, own, cand = url_host(url), project_id(seed), project_id(url)
    footer = host.isin(*FOOTER_HOSTS) | url_key(F.substring_index(as_col(url), "#", 1)).isin(*FOOTER_URLS)
    hub = host.isin(*HUB_HOSTS)
    return case(
        (~is_http(url), "non_http"), (is_mirror(url) | is_ipfs(url), "deferred"), (is_social(url), "social_deferred"), (is_explorer(url), "explorer_deferred"),
        (footer, "molecule_footer_blocked"), (host.isin(*HUB_BLOCKED_HOSTS), "molecule_ecosystem_blocked"),
        (hub & ~F.coalesce(own == cand, F.lit(False)), "molecule_catalog_blocked"),
        (~hub & is_catalog_path(url_path(url)), "catalog_blocked"), (~hub & (url_key(url) == url_key(seed)), "duplicate_seed"))


def keep_link(url, title) -> Column:
    """Links worth listing: not pulled already, no catalogue field, no explorer, no bare home page."""
    host = url_host(url)
    home = (host == "molecule.xyz") & (F.rtrim(url_path(url), F.lit("/")) == "")
    explorer = (host == "etherscan.io") | F.endswith(host, F.lit(".etherscan.io"))
    return ~as_col(title).isin(*SKIPPED_TITLES, *PULLED_TITLES) & ~(is_http(url) & (home | explorer))


def is_error_page(status, text, html) -> Column:
    both = F.concat_ws("\n", F.lower(text_of(text)), F.lower(F.substring(text_of(html), 1, 8000)))
    hits = F.array(*[F.contains(both, F.lit(p)) for p in ERROR_PHRASES])
    return F.coalesce(as_col(status) == 404, F.lit(False)) | F.array_contains(hits, True)


def strip_boilerplate(text) -> Column:
    bad = "(?i)" + "|".join(f"(?:{p})" for p in BOILERPLATE_LINES)
    return strip_space(F.array_join(F.filter(split_lines(text), lambda x: ~strip_space(x).rlike(bad)), "\n"))


def is_nav(text) -> Column:
    """Link-like lines make up 55% or more of the filled lines."""
    lines = F.filter(split_lines(text), lambda x: strip_space(x) != "")
    linkish = F.filter(lines, lambda x: strip_space(x).rlike(r"^[*\-\[]") | F.contains(x, F.lit("](http")) | strip_space(x).isin("More", "Copy"))
    return (F.size(lines) == 0) | (F.size(linkish) / F.greatest(F.size(lines), F.lit(1)) >= 0.55)


def meaningful_length(text) -> Column:
    s = F.regexp_replace(as_col(text), r"!\[[^\]]*\]\([^)]*\)", "")
    s = F.regexp_replace(s, r"\[[^\]]*\]\([^)]*\)", "")
    return F.length(collapse(F.regexp_replace(s, r"[#>*_`~\[\]|\\-]", " ")))
