"""Labelled web pages that the extraction model learns from: hand-written articles among hand-written surroundings.

Elements with data-main hold main text, data-main="no" takes parts out. Each article stands in several pages, each time among
other surroundings, so that neither is known by its company alone; what stands inside an article's own element without being part of it
(adverts, notices, forms, reader comments) is marked so.
"""

from __future__ import annotations

TOPS = [
    '<header><div class="logo"><a href="/">The Harbour Post</a></div><p>Independent reporting from the coast since 1921.</p></header>',
    '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">Sport</a></li><li><a href="/d">Culture</a></li></ul></nav>',
    '<div id="header"><h1>Field Notes</h1><div class="tagline">A weblog about birds, boats and bad weather, written whenever it rains.</div></div>',
    '<div class="navbar"><a href="/x">Start</a> | <a href="/y">Archive</a> | <a href="/z">Contact</a></div>',
    '<ul class="menu"><li><a href="1">Produkte</a><li><a href="2">Preise</a><li><a href="3">Über uns</a><li><a href="4">Kontakt</a></ul>',
    '<div class="cookie-banner" role="dialog"><p>We use cookies and similar technologies to improve this site, to measure its audience and to show you adverts that suit you. '
    'You can change your choice at any time.</p><button>Accept all</button> <a href="/privacy">Manage preferences</a></div>',
    '<div class="notice">This website will be unavailable on Sunday between two and four in the morning while our servers are moved.</div>',
    '<div id="breadcrumbs"><a href="/">Home</a> › <a href="/w">World</a> › <a href="/w/e">Europe</a></div>',
    '<div class="ad">Sleep better tonight. The new mattress by Dormano, now with thirty nights of trial and free delivery to your door.</div>',
    '<div class="ad">Nur heute: zwei Paar Schuhe kaufen, eines bezahlen.</div>',
    '<form action="/search"><label for="q">Search this site</label><input id="q" name="q"><input type="submit" value="Go"></form>',
    '<div class="alert alert-warning"><strong>Service notice:</strong> Deliveries to the islands are delayed by storms. We apologise for any inconvenience.</div>',
    '<aside class="left"><h3>Sections</h3><ul><li><a href="#">Politics</a></li><li><a href="#">Business</a></li></ul></aside>',
    '<div class="topbar"><span>Tuesday, 4 March</span> <a href="/login">Log in</a> <a href="/subscribe">Subscribe</a></div>',
    '<div class="masthead"><a href="/">La Gazette du Midi</a><p>Le quotidien des villages et des vallées.</p></div>',
    '<div role="navigation"><a href="#content">Skip to content</a><a href="/en">English</a><a href="/fr">Français</a></div>',
    '<!-- ad 7 --><div class="advert banner">Advertisement<p>Discover the islands this summer: seven nights, half board, flights included, from 399 per person.</p></div>',
    '<div class="site-notice"><p>You are reading an archived version of this page. It is no longer updated and may be out of date.</p></div>',
    '<div class="toc"><h2>Contents</h2><ol><li><a href="#1">Background</a></li><li><a href="#2">Method</a></li><li><a href="#3">Results</a></li></ol></div>',
    '<div id="gdpr-consent" class="overlay"><h2>Your privacy</h2><p>We and our partners store information on your device. Please tell us whether you agree.</p><a href="#">Agree</a></div>',
    '<div class="nav-links"><span>Ressorts</span><a href="/p">Politik</a><a href="/k">Kultur</a></div>',
    '<div class="toolbar search"><span>Font size</span> <a href="#">A</a> <a href="#">B</a><form><input name="q"></form></div>',
    '<div class="ads"><p>Hotel am See: drei Nächte mit Frühstück, buchbar bis Ende des Monats.</p></div>',
    '<section class="banner info-bar" role="alert"><p>New opening hours: from April the reading room is open until eight in the evening.</p></section>',
    '<header role="banner"><h1><a href="/">Mountain Courier</a></h1><p class="slogan">News from above the tree line, printed below it.</p><nav><a href="/n">News</a> <a href="/m">Maps</a></nav></header>',
    '<menu><li><a href="/es">Inicio</a></li><li><a href="/es/n">Noticias</a></li></menu>',
]
BOTTOMS = [
    '<footer>&copy; www.harbourpost.example &middot; All rights reserved. Reproduction in whole or in part only with written permission.</footer>',
    '<footer><p>Harbour Post is published by a trust. Our offices are open on weekdays from nine to five, and readers are always welcome to call in.</p>'
    '<ul><li><a href="/imprint">Imprint</a></li><li><a href="/privacy">Privacy</a></li></ul></footer>',
    '<div id="footer">Copyright 2011 by the authors. Powered by a small server in a cupboard.</div>',
    '<section class="comments"><h3>3 comments</h3><div class="comment"><b>marta</b><p>I was there too, and I can only agree with every word of this. The queue went twice around the square.</p></div>'
    '<div class="comment"><b>old_tom</b><p>Not sure about the second part. In my day we simply walked across the river, and nobody wrote an article about it.</p></div></section>',
    '<ol class="commentlist"><li class="comment"><p>Thank you, this helped me a lot!</p></li><li class="comment"><p>Does it work with goat milk as well? Mine went grey after two days.</p></li></ol>',
    '<div id="comments"><h2>Kommentare</h2><p>Genau so habe ich es auch erlebt, danke für den Bericht.</p><p>Das sehe ich ganz anders, aber jeder wie er mag.</p></div>',
    '<div id="respond"><h3>Leave a reply</h3><form><label>Your name</label><input><label>Your comment</label><textarea>Write here</textarea><button>Send</button></form></div>',
    '<div class="sidebar"><h3>Popular</h3><p>Ten harbours you should see before the summer is over, and two that you should better avoid.</p><p><a href="/w">Why the ferry is late again</a></p></div>',
    '<aside><h4>About the author</h4><p>Ines Roth has written about the coast for twenty years and lives with two dogs in a lighthouse.</p></aside>',
    '<div class="related"><h3>Read more</h3><ul><li><a href="/1">The last ferry</a></li><li><a href="/2">Storm over the dunes</a></li><li><a href="/3">What the tide left</a></li></ul></div>',
    '<div class="share">Share this: <a href="#">Mail</a> <a href="#">Post</a> <a href="#">Print</a></div>',
    '<div class="newsletter"><p>Every Friday the best stories of the week in your inbox, free of charge and without any obligation.</p><form><input type="email"><button>Sign up</button></form></div>',
    '<div class="widget"><h3>Categories</h3><ul><li><a href="#">Boats</a> (12)</li><li><a href="#">Birds</a> (48)</li></ul></div>',
    '<div class="tags">Tags: <a href="/t/1">harbour</a>, <a href="/t/2">weather</a>, <a href="/t/3">fish</a></div>',
    '<div class="pagination"><a href="?p=1">1</a> <a href="?p=2">2</a> <a href="?p=3">3</a> <a href="?p=2">Next »</a></div>',
    '<div class="promo sponsored"><h4>Sponsored</h4><p>This family lowered its power bill by half with one simple box. Experts are surprised, and the box is nearly sold out.</p></div>',
    '<div class="disclaimer">The views expressed here are those of the author and do not necessarily reflect those of the publisher.</div>',
    '<div class="modal popup" hidden><p>Wait! Before you leave, take ten per cent off your first order.</p></div>',
    '<div role="complementary"><p>Wetter heute: bewölkt, 14 Grad, schwacher Wind aus West.</p></div>',
    '<div role="contentinfo">Impressum | Datenschutz | AGB</div>',
    '<section id="reader-comments"><article class="comment"><p>C\'est exactement ce que je pensais, merci pour cet article.</p></article><article class="comment"><p>Je ne suis pas d\'accord du tout.</p></article></section>',
    '<section id="reviews"><h3>What readers say</h3><blockquote>Made it twice already, and my children asked for more. Next time I will use less sugar.</blockquote></section>',
    '<div class="login-form"><p>Please log in to read on without interruption.</p><label>Password</label><input type="password"></div>',
    '<div class="discussion thread"><p class="reply">You forgot the old mill. It stood there until they built the road, and I have the photographs.</p></div>',
    '<div class="author-bio"><p>Our correspondent has lived in the valley since the railway closed and writes about what came after.</p></div>',
    '<div class="social"><a href="#">Follow us</a> <span>12,480 followers</span></div>',
    '<div class="recommended trending"><p>Recommended for you</p><p>What the new timetable means for people who dislike timetables.</p></div>',
    '<div id="side" class="column-right"><p>Partner offer: a year of tea, delivered monthly, at half the usual price.</p></div>',
    '<div id="bottom" class="legal foot"><p>Terms of use. Prices include tax. Errors and changes excepted.</p></div>',
    '<div class="feedback"><p>Was this page helpful?</p><label><input type="radio"> Yes</label> <label><input type="radio"> No</label></div>',
    '<section class="discussion"><h3>Leserkommentare</h3><ul><li>Endlich sagt es mal jemand.</li><li>Bei uns im Dorf ist es genauso, nur ohne Brücke.</li></ul></section>',
    '<div class="signup subscribe-box"><h3>Stay in touch</h3><p>Join nine thousand readers who get our letter on Sunday mornings.</p></div>',
    '<div class="rail"><p>Most read</p><ol><li>A bridge too short</li><li>The mayor and the goat</li></ol></div>',
]
INSIDE = [
    '<div class="ad">Aber jetzt: das neue Rad von Velo, leichter als je zuvor und in vier Farben.</div>',
    '<div class="advertisement"><p>Advertisement</p><p>Book your winter cruise before Friday and save up to forty per cent on selected cabins.</p></div>',
    '<aside class="related"><p>See also: <a href="/x">How the dunes were saved</a></p></aside>',
    '<div class="notice"><p>This article contains links to shops. If you buy something there, we may receive a small share of the price.</p></div>',
    '<form class="subscribe"><p>Enjoying this? Get our letter.</p><input type="email"><button>Join</button></form>',
    '<div class="share-buttons"><a href="#">Tweet</a><a href="#">Pin it</a></div>',
    '<nav class="pager"><a href="#">Previous</a> <a href="#">Next</a></nav>',
    '<section class="comments"><h4>Comments</h4><p>Great piece, I read it aloud to my whole family at breakfast.</p><p>First!</p></section>',
    '<div class="ad"><p>Learn Portuguese in ten minutes a day. The first month is free, and you can leave whenever you like.</p></div>',
    '<script>var t = "</p><p>not a paragraph</p>"; show(t);</script>',
    '<div id="comments"><div class="comment">I have tried this and it does not work. The glue never dried, and the cat was furious.</div></div>',
    '<div class="sidebar"><p>Did you know? The oldest boat in the harbour is older than the harbour itself.</p></div>',
]
ARTICLES = [
    '<article data-main><h1>Old bridge reopens after nine years</h1><p>The stone bridge over the Lenne was opened to walkers on Saturday. More than two thousand people crossed it on the first day.</p>{}'
    '<p>Its arches, built in 1746, had been closed since a flood carried away the middle pier. "We took every stone out, numbered it and put it back," said the engineer, Paula Hirt.</p>'
    '<p>Cars will not return. The council decided in May, by a narrow vote, to keep the bridge for walkers and bicycles only.</p></article>',
    '<div class="post"><h2 class="entry-title" data-main>How to keep sourdough alive</h2>{}<div class="entry-content" data-main><p>Feed it, and leave it alone. That is nearly all there is to say, but here is the long version.</p>'
    '<p>Take a spoon of the starter, twice as much flour and the same weight of water.<br>Stir until no dry flour is left.</p><ul><li>Keep it at room temperature if you bake every day.</li>'
    '<li>Keep it in the fridge otherwise.</li></ul><p>After a week in the cold, feed it twice before you bake.</p></div></div>',
    '<main data-main><h1>Installation</h1><p>Unpack the archive and run the setup program from its top folder.</p><pre>setup --prefix=/opt/tool</pre><h2>Options</h2>'
    '<table><tr><td>--prefix</td><td>Where files are put.</td></tr><tr><td>--quiet</td><td>Says nothing unless something fails.</td></tr></table>{}<p>Afterwards, open a new shell.</p></main>',
    '<div id="content" data-main><h1>Die Rückkehr der Störche</h1><p>Im Frühjahr zählten Freiwillige dreiundvierzig Paare, so viele wie seit den siebziger Jahren nicht mehr.</p>{}'
    '<p>Die Wiesen am Fluss werden später gemäht, und die Gräben bleiben im Sommer feucht. Das hilft auch Fröschen und Libellen.</p><p>Im August ziehen die ersten Jungvögel nach Süden.</p></div>',
    '<h1 data-main>Letter from the lighthouse</h1><p data-main>It has been raining for eleven days. The boats stay in, and so do we.</p>{}<p data-main>On Tuesday the mail came, with a parcel for nobody, '
    'which we opened all the same.</p><p data-main>Inside were nine lemons and a map.</p>',
    '<article class="story" data-main><header><h1>Un marché sous les arbres</h1></header><p>Chaque jeudi, une trentaine de marchands installent leurs étals sur la place, à l\'ombre des platanes.</p>'
    '<p>On y trouve des fromages, du miel, quelques outils et beaucoup de conversations.</p>{}<blockquote>Je viens pour les tomates, je reste pour les nouvelles.</blockquote></article>',
    '<article data-main><h1>IT!! WAS!! THE!! BEST!! NIGHT!!</h1><p><b>WE!! PLAYED!! UNTIL!! FOUR!! AND!! NOBODY!! LEFT.<br><p>THANK!! YOU!! ALL!! FOR!! COMING!! AND!! FOR!! SINGING!! ALONG.</p>{}<p>SEE!! YOU!! IN!! SPRING!!</p></article>',
    '<article data-main><h1>Short note</h1><p>The office is closed on Monday.</p>{}</article>',
    '<table><tr><td class="c1"><a href="a.htm">Back</a><br><a href="b.htm">Index</a></td><td data-main><h2>The canal boats of my uncle</h2><p>My uncle built four boats, and three of them floated. '
    'This page is about the fourth.</p>{}<p>He began it in the winter of 1968, in a barn that was shorter than the boat.</p><p>When spring came, he took out the wall.</p></td></tr></table>',
    '<section class="article-body" data-main><h1>Recipe: barley soup</h1><p>Serves four. Takes an hour, most of which you may spend reading.</p><h2>You need</h2><ul><li>200 g barley</li><li>2 carrots</li><li>1 onion</li>'
    '<li>salt</li></ul>{}<h2>Method</h2><ol><li>Wash the barley until the water stays clear.</li><li>Fry the onion gently, add the rest and cover with water.</li><li>Simmer for fifty minutes.</li></ol></section>',
    '<div class="x7"><div class="k2" data-main><h1>A theory of puddles</h1><p>Puddles form where the ground is lower than its surroundings, and where nobody has complained for long enough.</p>{}'
    '<p>In this essay I distinguish three kinds: the shallow, the deceptive, and the permanent.</p><p>The shallow kind is of interest only to birds, children and philosophers.</p></div></div>',
    '<div role="main" data-main><h1>Council minutes, 12 June</h1><p>Present: eleven members, the clerk, and a dog.</p>{}<h3>1. Roads</h3><p>The hole in Mill Lane was discussed. It was agreed to look at it.</p>'
    '<h3>2. Trees</h3><p>Two limes will be planted in autumn, at a cost of 340.50.</p></div>',
    '<article data-main><h1>De%%% las### calles*** viejas</h1><p>La%%% tarde### cae*** sobre%%% el### puerto&amp;&amp;&amp; y%%% nadie*** tiene### prisa.</p>{}<p>Los*** barcos%%% vuelven### despacio, con$$$ poca&amp;&amp;&amp; pesca%%% y*** mucho### cielo.</p></article>',
    '<article data-main><p>In the end it was the smallest of the three clocks that kept time.</p>{}<dl><dt>Tower clock</dt><dd>Slow by nine minutes, and stopped in frost.</dd><dt>Station clock</dt><dd>Fast, to help those who are late.</dd></dl>'
    '<figure><img src="c.jpg"><figcaption>The kitchen clock, in 1953.</figcaption></figure><p>It hangs in the museum now. Nobody winds it.</p></article>',
    '<div class="main-column"><article data-main><h1>What the survey found</h1><h2>Summary</h2><p>Of 1,204 people asked, 61 per cent had crossed the river at least once; of these, a third had meant to.</p>{}'
    '<h2>Method</h2><p>We asked on both banks, on three days, in good weather. Answers were written down at once.</p><p>See the annex for the questions.</p></article></div>',
    '<h1 data-main>Notes on mending nets</h1><p data-main>A net is mended from the edge inwards, with the same twine it was made of.</p>{}<p data-main>My grandmother did it without looking, '
    'and talked about the neighbours meanwhile.</p><h2 data-main>Tools</h2><ul data-main><li>a needle of bone or wood</li><li>a knife that is not too sharp</li></ul>',
    '<p data-main>Hier steht seit 1998 die Seite des Kegelvereins. Wir kegeln jeden zweiten Mittwoch, und Gäste sind willkommen.</p>{}<p data-main>Letztes Jahr haben wir dreimal gewonnen und elfmal nicht.</p>'
    '<p data-main>Unser Vorsitzender hat versprochen, dass es besser wird.</p>',
    '<h2 data-main>Trip report</h2><div data-main>We left at six, in fog, with two cars and one map.</div>{}<div data-main>By noon we had found the lake. It was smaller than we remembered, and there were cows in it.</div>'
    '<div data-main>Nobody swam.</div>',
    '<div class="content text"><h1 data-main>Wie man einen Drachen baut</h1><div data-main><p>Man braucht zwei Leisten, Papier, Schnur und Geduld.</p><p>Die Leisten werden über Kreuz gebunden; die kürzere liegt oben.</p>{}<p>Dann fehlt nur noch der Wind.</p></div></div>',
]
TIMES = 9                    # pages per article


def pages(of: range | None = None) -> list[str]:
    """Every article TIMES times, with surroundings taken in turn; `of` chooses among the pages, for held-out tests."""
    out = []
    for i in range(len(ARTICLES) * TIMES):
        article = ARTICLES[i % len(ARTICLES)]
        inside = INSIDE[i % len(INSIDE)] if i % 3 else ""
        if inside and not inside.startswith("<script"):
            inside = inside.replace(">", ' data-main="no">', 1)
        tops = [TOPS[(i * 3 + k * 7) % len(TOPS)] for k in range(i % 4 + 1)]
        bottoms = [BOTTOMS[(i * 5 + k * 7) % len(BOTTOMS)] for k in range(i % 5)]
        body = "".join(tops) + article.replace("{}", inside) + "".join(bottoms)
        if i % 4 == 1:
            body = f'<div id="page"><div class="wrapper">{body}</div></div>'
        out.append(f"<!DOCTYPE html><html><head><title>Page {i}</title><style>p{{margin:0}}</style></head><body>{body}</body></html>")
    return out if of is None else [out[k] for k in of]
