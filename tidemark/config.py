"""Settings and parameter tables."""

from __future__ import annotations

# Operating settings.
FACEBOOK_CAP_PER_PAGE = 50
TWITTER_CAP = 1000
RSS_CAP_PER_FEED = 50
MINUTES_BETWEEN_RUNS = 60
INTAKE_BOUND = 100
SCAN_CAP = 100_000
SUMMARY_WORDS = (10, 30)

# Opinion codes and their labels.
OPINION_LABELS = {
    "-1.0": "Muy malo",
    "-0.5": "Malo",
    "0.0": "Neutro",
    "0.5": "Bueno",
    "1.0": "Muy bueno",
}
NEUTRAL_OPINION = "0.0"

STORED_LANGUAGE = "Spanish"

# Default parameter table of function words; callers may pass their own.
STOPWORDS = {
    "English": "the of and to in is that it for with on this are be as by".split(),
    "French": "le la les de des et un une est que qui pas pour dans du au".split(),
    "German": "der die das und in den von zu mit ist nicht ein eine für auf dem".split(),
    "Spanish": "de la que el en y los se del las por con una su para no".split(),
}

# The followed feeds.
FEED_URLS = """
http://ep00.epimg.net/rss/elpais/portada.xml
http://www.idi.mineco.gob.es/portal/site/MICINN/rssPrensa
https://www.heraldo.es/index.php/mod.portadas/mem.rss
http://www.idi.mineco.gob.es/portal/site/MICINN/rssInnovacion
http://www.minetad.gob.es/telecomunicaciones/es-ES/Novedades/_layouts/genrss.aspx?List=listanovedades&View=vistanovedades
http://rss.universia.net/ES/Noticias_ES/es/
http://www.ticbeat.com/feed/
http://feeds.feedburner.com/unblogenred
http://www.zaragozadinamica.es/index.php?format=feed&type=rss
http://www.aemet.es/es/noticias.rss
http://www.rtve.es/rss/temas_aragon.xml
https://www.20minutos.es/rss/ciencia/
http://www.rtve.es/rss/temas_ciencia-tecnologia.xml
https://www.20minutos.es/rss/nacional/
http://www.antena3.com/rss/348683.xml
https://www.20minutos.es/rss/aragon/
http://www.plataformavoluntariado.org/verRSSNoticias.php
http://www.abc.es/rss/feeds/abc_EspanaEspana.xml
https://cienciaaldia.wordpress.com/feed/
http://www.tecnologiaeinnovacion.defensa.gob.es/es-es/RSS/Paginas/RssNoticias.aspx
http://rss.universia.net/ES/Noticias_ES/ciencia-tecnologia
http://www.espanaoriginal.com/verRSS.php?idc=1
http://estaticos.marca.com/rss/atletismo.xml
http://estaticos.elmundo.es/blogs/elmundo/elmundopordentro/index.xml
http://estaticos.elmundo.es/blogs/elmundo/clima/index.xml
http://estaticos.elmundo.es/blogs/elmundo/cosmos/index.xml
http://estaticos.elmundo.es/blogs/elmundo/verde/index.xml
http://estaticos.elmundo.es/elmundo/rss/navegante.xml
https://www.collagevintage.com/feed/
https://stylelovely.com/macarenagea/feed/
https://imanesdeviaje.com/feed/
http://feeds.feedburner.com/chavetas
http://feeds.feedburner.com/MilViatges
https://familiasenruta.com/feed/
https://ined21.com/feed/
http://www.laopinion.es/blogs/rss/owner/21232
https://uvaccesible.wordpress.com/feed/
http://barrapunto.com/index.rss
""".split()
