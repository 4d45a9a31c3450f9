"""A small labelled URL table, written by hand: what the URL filter learns from. 1 is blocked."""

UNWANTED = (
    "casino casino-online royal-casino bigcasino luckyslots slots-jackpot poker-room free-poker bets bet-now sports-bet betting free-spins "
    "roulette-win win-big lottery-win winmoney pills buy-pills cheap-meds online-pharma viagra diet-pills pillshop pharmacy-deals "
    "adult adult-video adultchat xxx xxx-tube sexcam hot-sex porn pornhub-mirror escort nude-pics dating-adult spam spam-mail "
    "spamlist linkfarm link-farm seo-farm farm-links content-farm ads ads-server adserver popup-ads click-ads banner-ads track "
    "tracker tracking-pixel ad-track clicktrack malware phishing-login fake-login free-money get-rich payday-loan cheap-loans "
    "crack-keys warez torrent-crack replica-watch fake-watches cheap-bags hack-tool free-download-crack"
).split()
ORDINARY = (
    "news city-news morningpost library national-library museum history weather garden gardening recipes kitchen cooking travel "
    "mountains hiking cycling running football chess music orchestra theatre cinema books reading poetry science physics "
    "chemistry biology astronomy geology mathematics university college school teachers learning courses health hospital clinic "
    "doctors research institute council government parliament court police transport railway airport harbour river forest meadow "
    "village townhall local-history photo gallery design architecture engineering software opensource docs manual support forum "
    "community family children parents animals birds ocean climate energy solar water economy market bank insurance jobs careers "
    "magazine journal review opinion essay stories letters archive encyclopedia dictionary translation language grammar station "
    "nation motion lantern thistle heather brother together feathers northern southern table marble stable cable bubble humble "
    "things morning evening building spring anderson hansen weston harbour-news open-data old-town east-side red-house"
).split()
ENDINGS = ("example.com", "example.net", "example.org")
FRONTS = ("", "www.", "blog.", "m.")
PATHS = ("/en/{}", "/de/{}.html", "/fr/{}/", "/es/{}", "/{}/index.html", "/")


#: Hosts that say nothing, under which a path alone tells.
PLAIN_HOSTS = ("www.example.com", "m.example.net", "shop.example.org", "blog.example.com", "info.example.net", "start.example.org", "page.example.com")
PATH_FORMS = ("/en/{name}", "/{name}/{n}.html", "/c/{name}?id={n}", "/{n}/{name}/", "/de/{n}-{name}")


def labelled_urls() -> list[tuple[str, int]]:
    """Each name once in a host and once in a path; fronts, endings and forms are dealt out evenly over both labels, so that these say nothing."""
    out = []
    for label, names in ((1, UNWANTED), (0, ORDINARY)):
        for i, name in enumerate(names):
            out.append((f"https://{FRONTS[i % 4]}{name}.{ENDINGS[i % 3]}{PATHS[i % 6].format(100 + 37 * i)}", label))
            out.append((f"https://{PLAIN_HOSTS[i % 7]}{PATH_FORMS[i % 5].format(name=name, n=200 + 53 * i)}", label))
    return out
