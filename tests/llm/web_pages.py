"""Hand-written pages with the text that is to be kept."""

A = "The committee met on Tuesday to discuss the harbour, and decided nothing at all."
B = "Fishing boats, however, left the port before noon; most of them came back empty."
C = "A spokesman said that the quotas for next year would be published in the spring."
LEAD = "Harbour plans delayed again"

PAGES = {
    "semantic": (
        f"<html><body><header><h1>Daily Shore</h1><nav><ul><li><a href=/a>News</a><li><a href=/b>Sport</a></ul></nav>"
        f"</header><main><article><h1>{LEAD}</h1><p>{A}<p>{B}<aside><h3>Related</h3><ul><li><a href=/c>More fish</a></ul>"
        f"</aside><p>{C}</article><section id=comments><h2>Comments</h2><div class=comment><p>I never trusted that "
        f"harbour, and neither did my father.</p></div></section></main><footer><p>All rights reserved, 2024.</footer>",
        [LEAD, A, B, C],
    ),
    "div soup": (
        f'<div id="top-bar"><a href="/">Home</a> | <a href="/x">Contact</a></div><div class="cookie-banner">We use cookies to '
        f'improve your visit. <button>Accept</button></div><div id="wrapper"><div id="main-content"><h1>{LEAD}</h1>'
        f'<p>{A}</p><div class="ad">Buy our boats today, cheap and fast.</div><p>{B}</p><p>{C}</p></div>'
        f'<div id="sidebar"><h3>Popular</h3><ul><li><a href="/1">One</a></li><li><a href="/2">Two</a></li></ul>'
        f'<p>Subscribe to our weekly letter.</p></div></div><div id="footer">Copyright Shore Media. <a href="/t">Terms</a></div>',
        [LEAD, A, B, C],
    ),
    "post": (
        f'<body><div class="navbar"><ul><li><a href="/">Start</a></li><li><a href="/about">About</a></li></ul></div>'
        f'<div class="post"><h2>{LEAD}</h2><div class="entry-content"><p>{A}</p><blockquote>{B}</blockquote>'
        f'<ul><li>{C}</li></ul></div></div><div class="comments"><ol class="commentlist"><li><p>Great story, thank you '
        f'for writing about it.</p></li><li><p>I saw the boats, too, and they were empty indeed.</p></li></ol>'
        f'<form action="/c"><label>Name</label><input name=n><textarea>Say something</textarea></form></div>'
        f'<div class="site-footer">Made with care.</div></body>',
        [LEAD, A, B, C],
    ),
    "references": (
        "<article><p>Fish &amp; chips cost &lt;5&nbsp;&pound; &#8212; or\n\n  less&#x2026;</p></article><footer>&copy; me</footer>",
        ["Fish & chips cost <5 £ — or less…"],
    ),
    "nothing": ("<html><body><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><script>if (a<b) c='</p>';</script>", []),
}


def wanted(name: str) -> str:
    return "\n\n".join(PAGES[name][1])
