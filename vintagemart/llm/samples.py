"""A small table of labelled web pages.

Elements that hold main text carry the attribute ``MARK``; what stands in no such element
is something else.  The pages differ in how much their markup says about the parts of a page.
"""

MARK = "data-main"

_MENU = "<ul><li><a href='/'>Home</a></li><li><a href='/news'>News of the day</a></li><li><a href='/about'>About us</a></li></ul>"
_LINE = "The harbour office counted forty ships on Monday, more than in any week since the new pier was opened"
_LONG = (
    f"{_LINE}, and the pilots say that the autumn will bring still more of them. Traders who had waited for better weather now"
    " send their goods all at once, so that the cranes work through the night and the warehouses behind the old wall are full."
    " Whoever wants a berth has to ask for it three days before, which the captains of small boats find hard to bear."
)
_MID = "Nobody on the quay could say why the lamp had gone out, but the keeper was asked to write a report by Friday."

PAGES = [
    # An article element with everything else outside it.
    f"<nav>{_MENU}</nav><div class='ad'>Cheap tickets for the whole family, only this week at the counter.</div><article data-main><h1>Forty"
    f" ships</h1><p>{_LONG}</p><p>Soon.</p><p>{_MID}</p><p>{_LONG}</p></article><footer>&copy; harbour.example. All rights reserved. {_LINE}.</footer>",
    f"<nav>{_MENU}</nav><div class='ad'>{_LINE}.</div><article data-main><h1>{_LINE}</h1><p>No.</p></article><footer>{_LONG}</footer>",
    f"<header><h1>The Daily Quay</h1><p>News for people on the water since 1890.</p></header><article data-main><p>{_MID}</p></article>"
    f"<div>{_LONG}</div><div>{_MID}</div><footer><p>{_MID}</p><a href='/imprint'>Imprint</a></footer>",
    # Other things inside the article.
    f"<main data-main><h2>Lamp</h2><p>{_LONG}</p></main><main><aside>{_LONG}</aside><form><p>{_MID}</p><label>Your address</label></form>"
    f"<div class='newsletter-signup'><h3>Our letter</h3><p>{_MID}</p></div></main><main data-main><ul><li>One lamp</li><li>Two ships</li></ul><p>{_MID}</p>"
    f"<p><a href='/report'>{_LINE}</a></p><blockquote>{_MID}</blockquote></main>",
    f"<article><nav>{_MENU}</nav><p data-main>{_MID}</p><div class='advert'>{_MID}</div><p data-main>End.</p><section id='comments'><h3>Comments"
    f"</h3><p>{_LONG}</p><p>I agree.</p></section><footer>{_MID}</footer></article><p>{_MID}</p>",
    # Names of classes instead of elements.
    f"<div id='top-nav'>{_MENU}</div><div class='cookie-notice'>{_LONG}</div><div class='post-content' data-main><h1>Forty ships</h1><p>{_LONG}"
    f"</p><p>Yes.</p><p>{_MID}</p></div><div class='sidebar'><h4>Most read</h4><p>{_LONG}</p></div><div class='comments'><p>{_LONG}</p><p>{_MID}</p></div>"
    f"<div class='footer'>{_LINE}.</div><div>{_MID}</div>",
    f"<div class='menu'>{_MENU}</div><div id='story' data-main><p>{_MID}</p><p>{_LONG} <a href='/pier'>The new pier</a> is one of them.</p><p>So it goes.</p></div>"
    f"<div class='related'><p><a href='/1'>{_LINE}</a></p><p>{_MID}</p></div><p>{_LONG}</p><h3>Also</h3><p>More.</p>",
    # No names at all: word counts and link density have to do.
    f"<div>{_MENU}</div><div data-main><h1>Forty ships in one week</h1><p>{_LONG}</p><p>{_MID}</p><p>{_LONG}</p></div><div><a href='/a'>Next story</a></div>"
    "<div>&copy; The Daily Quay</div>",
    f"<table><tr><td><a href='/'>Home</a> | <a href='/news'>News</a> | <a href='/mail'>Mail</a></td></tr><tr><td data-main><p>{_LONG}</p><p>{_LONG}</p><p>{_MID}"
    f"</p></td></tr><tr><td>All rights reserved</td></tr></table><p><a href='/1'>{_LINE}</a></p><p><a href='/2'>{_LINE}</a> today</p>",
    f"<div><a href='/'>The Daily Quay</a></div><div>{_MENU}</div><div data-main><p>{_MID}</p><p>{_LONG}</p><p>Nobody answered.</p><p>{_LONG}</p></div>"
    f"<div><a href='/p'>Privacy</a></div><div><a href='/t'>Terms of use</a></div><div>Print this page</div>",
    f"<div data-main><p>{_LONG}</p><p>{_MID}</p></div>",
    f"<p data-main>{_MID}</p><p data-main>{_LONG}</p><p data-main>{_MID}</p><ul><li><a href='/x'>{_LINE}</a></li><li><a href='/y'>Older news</a></li></ul>",
    # Nothing but other things.
    f"<div>{_MENU}</div><div><a href='/login'>Log in</a></div><div>Page 3</div><div><a href='/next'>Next</a></div><div>&copy; 2024</div>",
    f"<nav>{_MENU}</nav><header>{_LINE}</header><footer>{_LONG}</footer><form><p>{_LONG}</p></form>",
]
