"""User agents: bot detection as a native column, and families by an ordered rule table over an automaton of literals."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from logharrow.config import UserAgent

#: Families in their order, the first that fits holds: family; parts that must occur, in any case; what the major version follows (none: no version).
#: Fixed values.
BROWSERS = """
Googlebot; googlebot/; googlebot
Googlebot-Image; googlebot-image; googlebot-image
AdsBot-Google; adsbot-google; -
Mediapartners-Google; mediapartners-google; -
Google-InspectionTool; google-inspectiontool; google-inspectiontool
bingbot; bingbot; bingbot
BingPreview; bingpreview; bingpreview
msnbot; msnbot; msnbot
YandexBot; yandexbot; yandexbot
YandexImages; yandeximages; yandeximages
Baiduspider; baiduspider; baiduspider
DuckDuckBot; duckduckbot; duckduckbot
Yahoo! Slurp; slurp; -
Applebot; applebot; applebot
facebookexternalhit; facebookexternalhit; facebookexternalhit
FacebookBot; facebookbot; facebookbot
Twitterbot; twitterbot; twitterbot
LinkedInBot; linkedinbot; linkedinbot
Pinterestbot; pinterestbot; pinterestbot
Slackbot; slackbot; slackbot
Discordbot; discordbot; discordbot
TelegramBot; telegrambot; -
WhatsApp; whatsapp/; whatsapp
SkypeUriPreview; skypeuripreview; -
AhrefsBot; ahrefsbot; ahrefsbot
SemrushBot; semrushbot; semrushbot
MJ12bot; mj12bot; mj12bot v
DotBot; dotbot; dotbot
PetalBot; petalbot; -
SeznamBot; seznambot; seznambot
Sogou web spider; sogou web spider; sogou web spider
Exabot; exabot; exabot
CCBot; ccbot; ccbot
GPTBot; gptbot; gptbot
Bytespider; bytespider; -
Amazonbot; amazonbot; amazonbot
DataForSeoBot; dataforseobot; dataforseobot
BLEXBot; blexbot; blexbot
UptimeRobot; uptimerobot; uptimerobot
Pingdom; pingdom; -
StatusCake; statuscake; -
archive.org_bot; archive.org_bot; -
ia_archiver; ia_archiver; -
Nutch; nutch; nutch-
HeadlessChrome; headlesschrome; headlesschrome
PhantomJS; phantomjs; phantomjs
curl; curl/; curl
Wget; wget/; wget
Python Requests; python-requests; python-requests
Python aiohttp; aiohttp; aiohttp
Python-urllib; python-urllib; python-urllib
HTTPX; python-httpx; python-httpx
Scrapy; scrapy; scrapy
Go-http-client; go-http-client; go-http-client
okhttp; okhttp; okhttp
Apache-HttpClient; apache-httpclient; apache-httpclient
Java; java/; java/1.
libwww-perl; libwww-perl; libwww-perl
Ruby; ruby/; ruby
node-fetch; node-fetch; node-fetch
axios; axios/; axios
GuzzleHttp; guzzlehttp; guzzlehttp
Postman; postmanruntime; postmanruntime
Insomnia; insomnia/; insomnia
HTTPie; httpie; httpie
PowerShell; powershell/; powershell
Dalvik; dalvik; dalvik
CFNetwork; cfnetwork; cfnetwork
Electron; electron/; electron
Edge Mobile; edga/; edga
Edge Mobile; edgios/; edgios
Edge; edge/; edge
Edge; edg/; edg
Opera Mini; opera mini; opera mini
Opera Mobile; opera mobi; version
Opera Mobile; opr/ mobile; opr
Opera; opr/; opr
Opera; opera; opera
Vivaldi; vivaldi; vivaldi
Yandex Browser; yabrowser; yabrowser
Brave; brave/; brave
Whale; whale/; whale
QQ Browser Mobile; mqqbrowser; mqqbrowser
QQ Browser; qqbrowser; qqbrowser
UC Browser; ucbrowser; ucbrowser
Sogou Explorer; metasr; metasr
Maxthon; maxthon; maxthon
MiuiBrowser; miuibrowser; miuibrowser
HuaweiBrowser; huaweibrowser; huaweibrowser
Samsung Internet; samsungbrowser; samsungbrowser
Silk; silk/; silk
DuckDuckGo Mobile; duckduckgo/; duckduckgo
Instagram; instagram; instagram
Facebook; fbav/; fbav
Snapchat; snapchat; snapchat
Pinterest; pinterest/; pinterest
Line; line/; line
WeChat; micromessenger; micromessenger
Firefox iOS; fxios; fxios
Firefox Focus; focus/; focus
SeaMonkey; seamonkey; seamonkey
PaleMoon; palemoon; palemoon
Waterfox; waterfox; waterfox
Firefox Mobile; firefox/ mobile; firefox
Firefox Mobile; firefox/ tablet; firefox
Firefox; firefox/; firefox
Chrome Mobile iOS; crios; crios
Chrome Mobile WebView; ; wv) chrome/; chrome
Chrome Mobile; chrome/ mobile; chrome
Chromium; chromium/; chromium
Chrome; chrome/; chrome
BlackBerry WebKit; blackberry; version
BlackBerry WebKit; bb10; version
Android; android version/; version
Mobile Safari; mobile safari version/; version
Safari; safari version/; version
Konqueror; konqueror; konqueror
Epiphany; epiphany; epiphany
Lynx; lynx/; lynx
Links; links (; links (
w3m; w3m/; w3m
IE Mobile; iemobile; iemobile
IE; msie; msie
IE; trident/ rv:; rv:
"""
SYSTEMS = """
Windows Phone; windows phone os; windows phone os
Windows Phone; windows phone; windows phone
Windows; windows nt; windows nt
Windows; windows; -
tvOS; apple tv; tvos
iOS; iphone; os
iOS; ipad; os
iOS; ipod; os
Fire OS; kfthwi; -
KaiOS; kaios; kaios
Tizen; tizen; tizen
webOS; web0s; -
webOS; webos; -
HarmonyOS; harmonyos; harmonyos
Android; android; android
Mac OS X; mac os x; mac os x
Chrome OS; cros; -
BlackBerry OS; blackberry; -
BlackBerry OS; bb10; -
FreeBSD; freebsd; -
OpenBSD; openbsd; -
NetBSD; netbsd; -
Solaris; sunos; -
Ubuntu; ubuntu; ubuntu
Fedora; fedora; fedora
Debian; debian; -
Linux; linux; -
"""
DEVICES = """
Spider; bot; -
Spider; crawler; -
Spider; spider; -
Spider; slurp; -
iPhone; iphone; -
iPad; ipad; -
iPod; ipod; -
Apple TV; apple tv; -
Mac; macintosh; -
Kindle; kindle; -
Kindle; silk/; -
PlayStation; playstation; -
Xbox; xbox; -
Nintendo; nintendo; -
Chromecast; crkey; -
Smart TV; smart-tv; -
Smart TV; smarttv; -
BlackBerry; blackberry; -
Generic Smartphone; android mobile; -
Generic Tablet; android; -
Generic Smartphone; windows phone; -
"""
FIELDS = ["browser_family", "browser_version", "os_family", "os_version", "device_family"]
#: Agents whose families a worker remembers.
REMEMBERED = 1 << 17


def _lines(table: str) -> list[tuple[str, tuple[str, ...], re.Pattern | None]]:
    """Family, its parts, and the pattern of its version, of each rule."""
    out = []
    for line in table.strip().splitlines():
        family, rest = line.split("; ", 1)
        parts, version = rest.rsplit("; ", 1)
        out.append((family, _parts(parts), None if version == "-" else re.compile(re.escape(version) + r"[/ ]?v?(\d+)")))
    return out


#: Parts that stand beside others in one rule. Fixed values.
BESIDE = ("mobile", "tablet", "version/", "safari", "chrome/", "rv:")


def _parts(text: str) -> tuple[str, ...]:
    """ "opr/ mobile" is two parts, "opera mini" one: what stands in BESIDE is cut off."""
    words = text.split(" ")
    cut = len(words)
    while cut > 1 and words[cut - 1] in BESIDE:
        cut -= 1
    return (" ".join(words[:cut]), *words[cut:])


@lru_cache(None)
def _automaton():
    """Aho-Corasick automaton of all parts of all rules: one run over an agent tells which of them occur."""
    import ahocorasick

    tables = [_lines(t) for t in (BROWSERS, SYSTEMS, DEVICES)]
    found = ahocorasick.Automaton()
    for part in {p for t in tables for _, parts, _ in t for p in parts}:
        found.add_word(part, part)
    found.make_automaton()
    return found, tables


@lru_cache(REMEMBERED)
def families(agent: str | None) -> tuple[str, str, str, str, str]:
    """FIELDS of an agent. Logged agents have plus signs for blanks; null, empty and "-" are no agent."""
    if agent in (None, "", "-"):
        return "Other", "", "Other", "", "Other"
    text = agent.replace("+", " ").lower()
    automaton, tables = _automaton()
    there = {part for _, part in automaton.iter(text)}
    out = []
    for table in tables:
        for family, parts, version in table:
            if all(p in there for p in parts):
                number = version and version.search(text)
                out += [family, number[1] if number else ""]
                break
        else:
            out += ["Other", ""]
    return tuple(out[:5])


def is_bot(agent: Column, config: UserAgent = UserAgent()) -> Column:
    pattern = "(?i)" + "|".join(f"(?:{p.removeprefix('(?i)')})" for p in config.bot_patterns)
    return F.coalesce(~agent.isin("", "-") & agent.rlike(pattern), F.lit(False))


@F.arrow_udf(StructType([StructField(f, StringType()) for f in FIELDS]))
def _families(agents):
    """A batch's distinct agents are looked up once each."""
    import pyarrow as pa

    coded = agents.dictionary_encode()
    known = [families(a) for a in coded.dictionary.to_pylist()]
    known.append(families(None))
    at = coded.indices.fill_null(len(known) - 1)
    columns = [pa.array([k[i] for k in known], pa.string()).take(at) for i in range(len(FIELDS))]
    return pa.StructArray.from_arrays(columns, FIELDS)


def parse_agent(agent: Column) -> Column:
    """Struct: browser_family, browser_version, os_family, os_version, device_family, bot_flag, raw."""
    found = _families(agent)
    return F.struct(*[found[f].alias(f) for f in FIELDS], is_bot(agent).cast("int").alias("bot_flag"), F.coalesce(agent, F.lit("")).alias("raw"))
