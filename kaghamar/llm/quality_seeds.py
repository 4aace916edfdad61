"""Small seed texts of each structural profile; the profiles of `quality` are the means of their distributions.

All seeds are written for this purpose. A kind has one profile per visible form, since a table of
pipes and a table of tabs share little.
"""

from __future__ import annotations

import random

#: Function words of the languages of the corpus (hy also in Latin letters).
FUNCTION_WORDS = """
և է էր են որ այդ իսկ քանի երբ ապա եթե պետք ավելի քան մինչև միջև ըստ թե այն այս մի ու բայց սակայն որպեսզի թեև ուստի որովհետև ոչ էլ ես դու մենք նրանք համար մասին հետո առաջ նաև միայն դեռ
e er en or ayd isk qani erb apa ete petq aveli qan minchev mijev yst te ayn ays mi u bayc sakayn ev che chi
и в на не что как по с за из этот он она это для но а к о у же его ее все также или чтобы однако
і й та що як з до це про від але або вона він коли
the a an of and in to is was that by for with on as it at from but or not are were be this which after before because
le la les de des et un une en dans est que du au aux pour par sur ne pas il elle mais ou avec ce cette d l qu
der die das und ein eine in den von mit ist dem im zu auf für des nicht sich als auch an es aber oder
و در به از که این را با است آن بر یک برای تا هم بود شد
და არის რომ ეს იყო თუ არ მაგრამ ან როგორც მის რომელიც
""".split()

PROSE = [
    "Գյուղի բնակիչները վաղ առավոտյան հավաքվեցին կամրջի մոտ, որովհետև գիշերը ջուրը բարձրացել էր, և ոչ ոք չգիտեր, թե երբ կնվազի։ Տարեց մի մարդ ասաց, որ պետք է սպասել մինչև երեկո։ Հետո բոլորը տուն գնացին։",
    "Երեկ մեր հարևանը նոր դուռ դրեց իր տան մուտքի մոտ։ Նա ասաց, որ հինը երկու տարի առաջ էր կոտրվել, իսկ վարպետը միայն հիմա էր ժամանակ գտել։ Արդյո՞ք դա ճիշտ է, ոչ ոք չգիտի։",
    "Դպրոցի տնօրենը 1998 թվականին որոշեց, որ ամեն աշակերտ պետք է մի ծառ տնկի, և այդ օրվանից այգին մեծացել է ավելի քան 40 անգամ։",
    "— Ինչո՞ւ ես այդպես մտածում,— հարցրեց նա։\n— Որովհետև երեկ տեսա, թե ինչպես էր դուռը բացվում, և ոչ ոք ներս չմտավ։\n— Գուցե քամին էր, չգիտեմ, բայց պետք է ստուգել։",
    "Այս պատմությունը սկսվում է փոքրիկ մի\nքաղաքում, որտեղ ոչ ոք չէր սպասում, որ\nձմեռը այդքան երկար կտևի։ Երեխաները\nամեն օր գնում էին լիճը։",
    "\tԵրեկ\tմեր\tհարևանը նոր դուռ դրեց\nիր տան մուտքի\nմոտ, որովհետև հինը կոտրվել\nէր, իսկ վարպետը միայն\nհիմա էր ժամանակ գտել, ասում\nեն բոլորը\n",
    "Գյուղի բնակիչները հավաքվեցին կամրջի մոտ\nգիշերը ջուրը բարձրացել էր\nև ոչ ոք չգիտեր թե երբ կնվազի\nտարեց մի մարդ ասաց որ պետք է սպասել\nմինչև երեկո\nհետո բոլորը տուն գնացին\n",
    "Դպրոցը (the old garden wall) վերանորոգել է «նոր դուռ» ցուցահանդեսը 1890 թվականին, քանի որ 300 աշակերտ չուներ\nնոր սենյակ։ Ո՛չ ուսուցիչը, ո՛չ էլ տնօրենը գիտեին այդ մասին։",
    "ԵՐԵԿ ՄԵՐ ՀԱՐԵՎԱՆԸ ՆՈՐ ԴՈՒՌ ԴՐԵՑ ԻՐ ՏԱՆ ՄՈՒՏՔԻ ՄՈՏ, ՈՐՈՎՀԵՏԵՎ ՀԻՆԸ ԿՈՏՐՎԵԼ ԷՐ, ԻՍԿ ՎԱՐՊԵՏԸ ՄԻԱՅՆ ՀԻՄԱ ԷՐ ԺԱՄԱՆԱԿ ԳՏԵԼ։",
    "Erek mer harevany nor dur drec ir tan mutqi mot, orovhetev hiny kotrvel er. Na asac, or petq e spasel minchev ereko, ev bolory tun gnacin.",
    "Вчера утром жители деревни собрались у моста, потому что ночью поднялась вода, и никто не знал, когда она спадёт. Старик сказал, что надо подождать до вечера. Потом все разошлись по домам.",
    "Директор школы в 1998 году решил, что каждый ученик посадит дерево, и с тех пор сад вырос в 40 раз.",
    "Учора вранці мешканці села зібралися біля мосту, бо вночі піднялася вода, і ніхто не знав, коли вона спаде. Старий чоловік сказав, що треба почекати до вечора.",
    "Early in the morning the people of the village met at the bridge, because the water had risen in the night and nobody knew when it would fall. An old man said that they should wait until the evening.",
    "In 1998 the head of the school decided that every pupil would plant a tree, and since then the garden has grown\nmore than 40 times. The last of them was planted\nyesterday by the lake.",
    "Tôt le matin, les habitants du village se sont réunis près du pont, parce que l’eau était montée pendant la nuit et que personne ne savait quand elle baisserait. Un vieil homme a dit qu’il fallait attendre.",
    "Am frühen Morgen trafen sich die Bewohner des Dorfes an der Brücke, weil das Wasser in der Nacht gestiegen war und niemand wusste, wann es fallen würde. Ein alter Mann sagte, dass man bis zum Abend warten müsse.",
    "صبح زود مردم روستا کنار پل جمع شدند، زیرا شب گذشته آب بالا آمده بود و هیچ‌کس نمی‌دانست کی پایین می‌رود. پیرمردی گفت که باید تا شب صبر کرد.",
    "დილით ადრე სოფლის მცხოვრებლები ხიდთან შეიკრიბნენ, რადგან ღამით წყალმა მოიმატა და არავინ იცოდა, როდის დაიკლებდა. მოხუცმა თქვა, რომ საღამომდე უნდა დაეცადათ.",
]

NAMES = "սեղան;փայտե աթոռ;նոր դուռ;կարմիր գիրք;պատուհանը;մեծ ծառ;ամպը;ջուր;հին ժամացույց;կանաչ խոտ;լուսամուտը;սև թուղթ;դեղին տերև;քար;ավազ".split(";")
OTHERS = ["the wooden chair;an old clock;the red book;a piece of green grass;the new door;the window;several black papers;the yellow leaf of the tree;a stone;the sand".split(";"),
          "wooden chair;an old clock;the red book;green grass;a new door;the window;black paper;the yellow leaf;a stone;sand;river;the long rope".split(";"),
          "деревянный стул;старые часы;красная книга;зелёная трава;новая дверь;окно;чёрная бумага;жёлтый лист;камень;песок;река;верёвка".split(";"),
          "une chaise;la vieille horloge;le livre rouge;herbe verte;une porte;la fenêtre;papier noir;feuille jaune;pierre;sable".split(";"),
          "صندلی چوبی;ساعت کهنه;کتاب سرخ;علف سبز;در تازه;پنجره;کاغذ سیاه;برگ زرد;سنگ;ماسه".split(";"),
          "ხის სკამი;ძველი საათი;წითელი წიგნი;მწვანე ბალახი;ახალი კარი;ფანჯარა;შავი ქაღალდი;ყვითელი ფოთოლი;ქვა;ქვიშა".split(";")]


def seeds() -> dict[tuple[str, str], list[str]]:
    """(kind, form) -> texts."""
    r = random.Random(7)
    out: dict[tuple[str, str], list[str]] = {("prose", f"seed{i}"): [t] for i, t in enumerate(PROSE)}

    for family, texts in (("hy", PROSE[:3]), ("hy", PROSE[2:6]), ("ru", PROSE[-9:-7]), ("en", PROSE[-6:-4]), ("fr", PROSE[-4:-3]), ("de", PROSE[-3:-2])):
        for text in texts:
            bare = "".join(c for c in text if c.isalnum() or c.isspace())
            ragged = lambda s: "".join("\n" if c == " " and r.random() < 0.3 else c for c in s)
            for form, variant in (("bare", bare), ("ragged", ragged(text)), ("ragged-bare", ragged(bare))):
                out.setdefault(("prose", f"{family}-{form}"), []).append(variant)

    def add(kind: str, form: str, text: str) -> None:
        # entries with articles hold function words, so they get profiles of their own
        out.setdefault((kind, form + "+articles" * (kind == "list" and " the " in f" {text.lower()}")), []).append(text)

    for words in [NAMES, *OTHERS]:
        n = min(len(words), 10)
        pick = lambda: r.sample(words, n)  # noqa: E731, B023
        add("list", "numbered", "\n".join(f"{i + 1}. {w}" for i, w in enumerate(pick())))
        add("list", "numbered", "\n".join(f"{i + 1}) {w}" for i, w in enumerate(pick())))
        add("list", "bulleted", "\n".join(f"- {w}" for w in pick()))
        add("list", "bulleted", "\n".join(f"• {w}" for w in pick()))
        add("list", "bulleted", "\n".join(f"* {w}" for w in pick()))
        add("list", "lines", "\n".join(pick()))
        add("list", "amounts", "\n".join(f"{r.randint(1, 900)} գ {w}" for w in pick()))
        add("list", "contents", "\n".join(f"{i // 4 + 1}.{i % 4 + 1} {w} {'.' * r.randint(7, 30)} {3 + 4 * i}" for i, w in enumerate(pick())))
        for mark in ("|", "•", "»", ">", "/", "·"):
            add("list", "menu" if mark == "|" else "trail", f" {mark} ".join(w.capitalize() for w in pick()))
        add("list", "tags", " ".join(f"#{w}" for w in pick()))
        add("list", "commas", ", ".join(pick()))
        add("list", "commas", "; ".join(pick()))
        add("list", "outline", words[0] + ":\n" + "\n".join(f"\t{w};" for w in pick()))
        for mark in (",", ";", "\t", " | ", "      "):
            cells = [[w.split()[0] for w in r.sample(words, 5)]] + [[r.choice(words).split()[-1], *(r.choice([str(r.randint(100, 99999)), f"{r.randint(1, 99)}.{r.randint(0, 9)}", "-", str(r.randint(1900, 2020))]) for _ in range(4))] for _ in range(6)]
            form = {",": "csv", ";": "csv", "\t": "tabs", " | ": "pipes", "      ": "spaces"}[mark]
            add("table", form, "\n".join(mark.join(c) for c in cells))
            if mark == " | ":
                add("table", form, "\n".join(f"| {mark.join(c)} |" for c in cells))
                add("table", "markup", "<table>" + "".join("<tr>" + "".join(f"<td>{x}</td>" for x in c) + "</tr>" for c in cells) + "</table>")
        one = words[1].split()[-1]
        add("junk", "repeat", " ".join([one] * 30))
        add("junk", "repeat-lines", "\n".join([one] * 24))
        add("junk", "repeat-commas", ", ".join([one] * 24))
    for text in PROSE[:3] + PROSE[7:9]:
        add("junk", "decoding", text.encode().decode("cp437"))
        add("junk", "decoding", text.encode().decode("cp866"))
        add("junk", "decoding-latin", text.encode().decode("latin-1"))
        add("junk", "decoding-latin", text.encode().decode("cp1252", "replace"))
        add("junk", "decoding-cyrillic", text.encode().decode("cp1251", "replace"))
        add("junk", "replacement", "".join(r.choice([c, "�", "?"]) for c in text))
        add("junk", "recognition", "".join(c + r.choice([" ", " ", ". ", "1 ", "| ", "; ", "l "]) for c in text if c.strip()))
    for share in (0.1, 0.3, 0.5):
        for text in PROSE[:3]:
            noise = lambda c: c + (r.choice("1Il|';.") if r.random() < share else "") + " "  # noqa: E731, B023
            add("junk", f"recognition-{share}", "".join(noise(c) for c in text if c.strip()))
    for _ in range(4):
        add("junk", "signs-many", "".join(r.choice("!?@#$%^&*()_+-=[]{}|/<>,.~ \\") for _ in range(240)))
        add("junk", "letters", "".join(r.choice("abcdefghijklmnopqrstuvwxyz  ,;") for _ in range(300)))
        add("junk", "letters-spaced", "".join(r.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(300)))
        add("junk", "signs", "".join(r.choice("*-_=.  ") for _ in range(240)))
        add("junk", "encoded", "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(300)) + "==")
        add("junk", "encoded", " ".join("%02x" % r.randint(0, 255) for _ in range(120)))
    add("junk", "style", ".menu-3{margin:2px 0 9px;color:#e48e9b}\n#top9 li a:hover{padding:1em}\n.box p{font-size:12px;border:1px solid #ccc}")
    add("junk", "program", "var a=document.getElementById('b1');if(a){a.style.display='none';}function f1(x){return x*7;}//var a=document.getElementById('b1');")
    add("junk", "program", "for (int i = 0; i < n; i++) { sum += a[i] * b[i]; }\nreturn sum / n;\nprintf(\"%d\\n\", sum);")
    for text in (
        "import os\n\ndef read(path, size=10):\n    with open(path) as file:\n        rows = file.readlines()\n    return [x.strip() for x in rows if len(x) > size]\n",
        "class Box:\n    def __init__(self, a, b):\n        self.a = a\n        self.b = b\n\n    def sum(self):\n        return self.a + self.b\n",
        "for name in names:\n    if name not in seen:\n        seen.add(name)\n        print(name)\n    else:\n        count += 1\nexit(0)\n",
        "def main():\n    values = [1, 2, 3]\n    best = None\n    for v in values:\n        if best is None or v > best:\n            best = v\n    print(best)\n",
    ):
        add("junk", "program-indented", text)
    for text in (
        '{"title": "x", "count": 3, "items": [{"a": 1, "b": 2}, {"a": 5, "b": null}], "done": false}', '[{"id": 1, "v": "a"}, {"id": 2, "v": "b"}, {"id": 3, "v": "c"}]',
        '{\n  "name": "box",\n  "size": [10, 20],\n  "parts": {"lid": true, "lock": null},\n  "color": "red"\n}', '{"user": {"id": 42, "mail": "a@b.example"}, "roles": ["x", "y"], "age": 30, "ok": true}',
    ):
        add("junk", "record", text)
    for text in (
        ".box { margin: 0; padding: 5px; }\n.box p { font-size: 12px; color: #333; }\na:hover { text-decoration: underline; }", "body {\n  font-family: Arial;\n  background: #fff;\n  margin: 0 auto;\n}\nh1 {\n  color: red;\n}\n",
        "#head { width: 100%; border: 1px solid #000; }\n#head .logo { float: left; height: 40px; }",
    ):
        add("junk", "style-lines", text)
    for text in (
        "SELECT a.id, b.name FROM t1 a JOIN t2 b ON a.id = b.id WHERE a.x > 10 AND b.y IS NULL ORDER BY 1;", "<div class=\"a\"><ul id=\"m\"><li><a href=\"/x\">y</a></li></ul></div><script src=\"z.js\"></script>",
        "#!/bin/sh\nset -e\nfor f in *.txt; do\n  mv \"$f\" \"${f%.txt}.bak\"\ndone\necho \"ok\" > /dev/null\n", "if (a == b) {\n    c = d[i++];\n} else {\n    return NULL;\n}\nfree(p);\n",
    ):
        add("junk", "program-other", text)
    return out
