"""The small labelled URL table that the URL model learns from, and the rules
of the registered query."""

from __future__ import annotations

# The rules (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

# Hand-made examples; hosts are invented.
BLOCKED = """
http://casino-royal.test/en/12
https://blog.online-casino.test/en/15
http://www.bigwin-casino.test/bonus?ref=a
https://m.slots-casino.test/fr/7.html
http://win-big.test/de/31.html
https://www.poker-win.test/de/55
http://blog.free-bets-now.test/en/8
https://www.sportsbets.test/es/3
http://m.best-bets.test/en/1#top
https://free-spins.test/bets/
http://blog.cheap-meds.test/fr/62
https://pills-shop.test/en/88
http://www.cheap-viagra.test/order
https://m.discount-pills.test/fr/19?page=2
http://diet-pills-cheap.test/de/14
https://blog.cheap-watches.test/en/40
http://adult-videos.test/en/5
https://www.adult-chat.test/es/21
http://blog.xxx-adult.test/fr/4
https://adult-cams.test/en/1.html
http://m.adult-dating.test/es/9
https://blog.porn-x.test/en/77
http://ads-server.test/de/9
https://blog.banner-ads.test/en/3
http://m.ad-track.test/pixel.gif
https://track-clicks.test/en/90
http://www.ads-network.test/fr/24
https://m.tracker-ads.test/de/6
http://blog.spam-mail.test/en/70.html
https://spammer.test/en/21
http://www.link-farm.test/page/1
https://blog.seo-farm.test/es/58.html
http://m.spam-links.test/fr/3
https://content-farm.test/es/99.html
http://www.click-farm.test/en/2
https://blog.payday-loans.test/de/84
http://fast-loans-cheap.test/en/6
https://m.free-gift-win.test/es/45
http://www.crypto-win.test/en/33.html
https://warez-crack.test/fr/11
"""

ALLOWED = """
http://library.test/en/1
https://blog.daily-times.test/en/38?page=2
http://university.test/fr/75#top
https://m.gardening.test/es/15/
http://www.recipes.test/de/52.html
https://m.weather.test/en/89
http://blog.museum.test/en/29
https://software.test/fr/66?page=2
http://blog.encyclopedia.test/es/6#top
https://www.travel-notes.test/de/43/
http://m.hospital.test/en/80.html
https://www.city-council.test/en/20
http://open-data.test/fr/57
https://blog.weekly.test/es/94?page=2
http://science-journal.test/de/34#top
https://m.music-school.test/en/71/
http://www.photography.test/en/11.html
https://m.football-club.test/fr/48
http://blog.cooking.test/es/85
https://theatre.test/de/25?page=2
http://blog.nation.test/en/62#top
https://www.therapy.test/en/2/
http://m.station.test/fr/39.html
https://www.thinking.test/es/76
http://other.test/de/16
https://blog.heron.test/en/53?page=2
http://answers.test/en/90#top
https://m.language.test/fr/30/
http://www.linux-users.test/es/67.html
https://m.railway.test/de/7
http://blog.press.test/en/44
https://chess.test/en/81?page=2
http://blog.mountain.test/fr/21#top
https://www.bakery.test/es/58/
http://m.parliament.test/de/95.html
https://www.charity.test/en/35
http://history.test/en/72
https://blog.region.test/fr/12?page=2
http://northern.test/es/49#top
https://m.thunder.test/de/86/
http://www.motherland.test/en/26.html
https://m.education.test/en/63
http://blog.question.test/fr/3
https://translation.test/es/40?page=2
http://blog.table.test/de/77#top
https://www.stable.test/en/17/
http://m.possible.test/en/54.html
https://www.bicycle.test/fr/91
http://another.test/es/31
https://blog.weatherwatch.test/de/68?page=2
http://whether.test/en/8#top
https://m.father.test/en/45/
http://www.without.test/fr/82.html
https://m.author.test/es/22
http://blog.thousand.test/de/59
https://month.test/en/96?page=2
http://blog.earth.test/en/36#top
https://www.health.test/fr/73/
http://m.wealth.test/es/13.html
https://www.south.test/de/50
http://fourth.test/en/87
https://blog.growth.test/en/27?page=2
http://something.test/fr/64#top
https://m.everything.test/es/4/
http://www.morning.test/de/41.html
https://m.evening.test/en/78
http://blog.reading.test/en/18
https://writing.test/fr/55?page=2
http://blog.teaching.test/es/92#top
https://www.publishing.test/de/32/
http://m.fishing.test/en/69.html
https://www.shipping.test/en/9
http://english.test/fr/46
https://blog.spanish.test/es/83?page=2
http://finish.test/de/23#top
https://m.workshop.test/en/60/
http://www.friendship.test/en/97.html
https://m.scholarship.test/fr/37
http://blog.anthology.test/es/74
https://theology.test/de/14?page=2
http://blog.method.test/en/51#top
https://www.cathedral.test/en/88/
http://m.athletics.test/fr/28.html
https://www.marathon.test/es/65
http://mathematics.test/de/5
https://blog.panther.test/en/42?page=2
http://feather.test/en/79#top
https://m.leather.test/fr/19/
http://www.gather.test/es/56.html
https://m.together.test/de/93
http://blog.sister.test/en/33
https://register.test/en/70?page=2
http://blog.minister.test/fr/10#top
https://www.theorem.test/es/47/
http://m.therapist.test/de/84.html
https://www.thesis.test/en/24
"""


def labelled_urls() -> list[tuple[str, int]]:
    """(url, label); 1 marks URLs to block."""
    return [(u, 1) for u in BLOCKED.split()] + [(u, 0) for u in ALLOWED.split()]
