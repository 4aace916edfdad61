"""Small labelled table on which the personal-information tagger is trained.

Lines are written with marked items, `{kind|text}`; slots in capitals are filled from the lists
below, so that the tagger learns shapes and contexts and not certain people.
"""

from __future__ import annotations

import random
import re

GIVEN = {
    "hy": "Աննա Արմեն Արփինե Աշոտ Գագիկ Գայանե Գրիգոր Դավիթ Եղիշե Զարուհի Թամար Իսահակ Լևոն Լուսինե Կարինե Հակոբ Հովհաննես Մարինե Մկրտիչ Նաիրա Նուբար Շահեն Պետրոս Սամվել Վարդան Վիգեն Տաթև Ալիս Անի Արամ Արև Արտակ Արտաշես Բաբկեն Գևորգ Գոհար Գոռ Էդգար Լիլիթ Կարեն Հայկ Հասմիկ Հույս Հրայր Մանե Մարիամ Մհեր Նարե Նարեկ Նվարդ Շուշան Ռուբեն Սիրան Սոնա Սուրեն Վահագն Վահան Վահե Վարդ Տիգրան Քրիստինե Անահիտ Արթուր Աստղիկ Գուրգեն Ժաննա Մեսրոպ Հարություն Ռաֆայել Սարգիս Սոս Վազգեն Վիկտոր Էմմա Լիանա Նելլի Մերի Սյուզան Տիրուհի Արեգ Արմինե Երվանդ Խաչիկ Մանուկ Հենրիկ Կամո Աբել Արսեն Դերենիկ Ռոբերտ Ալեքսանդր",
    "en": "Alice Anna Andrew Arthur Charles Clara Dale Daniel David Edward Ella Emily Emma George Grace Grant Hannah Harry Henry Hope Ivy Jack James Jane John Kate Laura Lucy Mark Martin Mary Michael Nora Oliver Oscar Paul Peter Philip Rachel Robert Rose Ruth Samuel Sarah Simon Susan Thomas Tom Victor Violet Walter William Adam Alan Brian Carol Diana Eric Frank Helen Ian Joan Julia Karen Keith Kevin Linda Lisa Louis Maria Neil Nina Ralph Roger Roy Sam Sean Stella Steven Wendy Lily Max Leo Amy Eva Ben Joe Ann Luke Owen Dean Ray Carl",
    "ru": "Александр Алексей Анна Антон Артём Борис Вера Виктор Владимир Глеб Григорий Дарья Дмитрий Евгений Егор Елена Иван Игорь Ирина Кирилл Константин Лев Людмила Максим Мария Мирон Михаил Надежда Наталья Никита Николай Олег Ольга Павел Пётр Петр Роман Светлана Сергей Степан Татьяна Тимур Фёдор Юлия Юрий Яков Андрей Анастасия Василий Галина Зоя Инна Матвей Нина Полина Софья Тарас Ульяна Захар Семён",
}
SURNAMES = {
    "hy": "Աբրահամյան Ավետիսյան Գալստյան Գրիգորյան Դանիելյան Եղիազարյան Թորոսյան Խաչատրյան Կարապետյան Հարությունյան Մանուկյան Մինասյան Նազարյան Պետրոսյան Սահակյան Սարգսյան Տեր-Պողոսյան Փանոսյան Մարտիրոսյան Ավագյան Բադալյան Ղազարյան Շահբազյան Զաքարյան Վարդանյան Ներսիսյան Լալայանց Մելիքյան".replace("Տեր-Պողոսյան", "Պողոսյան"),
    "en": "Ashdown Barrowby Carrick Dunmore Ellsworth Farrow Greenhall Hartley Kendrick Larkwood Merriton Norwood Pemberton Ravensby Selwick Thornton Underhill Wetherby Brookdale Hazelmore Silverton Oakley Fairwick",
    "ru": "Белозёров Воронин Гаврилов Денисенко Ершов Жуков Зимин Калинин Лебедев Морозенко Никитин Орлов Панченко Рябинин Соколов Тимошенко Фролов Шевчук Лесков Дубинин Рыбаков Туманов Полищук Степанюк",
}
#: Streets without a type.
STREETS = {"hy": "Աբովյան Թումանյան Կոմիտասի Սարյան Տերյան Ծաղկավանի Այգեստանի Բարեկամության Խորենացու Կասկադի Լեռնուտի Վարդենիների Ուռենիների", "en": "Market Station Church Mill Park River Castle Orchard Bridge", "ru": "Садовая Лесная Школьная Набережная Вишнёвая Полевая Зелёная Озёрная"}
TOWNS = "Կարմիրգյուղ Լեռնավան Ջրաշեն Այգեձոր Բերդավան Ծաղկունք".split()

TEMPLATES = """
Զանգահարե՛ք {phone|PHONE} հեռախոսահամարով։ // Հեռ.՝ {phone|PHONE} // Կապվեք մեզ հետ {email|EMAIL} հասցեով։ // Գրել {email|EMAIL} կամ զանգել {phone|PHONE}։ // Նամակները ուղարկել՝ {email|EMAIL}
Բողոքը ներկայացրել է {name|NAMEHY}, անձնագիր՝ {identity|PASS}։ // Անձնագիր № {identity|PASS}, տրված {name|NAMEHY} անունով։ // Սոցիալական քարտ՝ {identity|SSN}։ // Պատճենը՝ ՀԾՀ՝ {identity|SSN}, {address|ADDRHY} // Նույնականացման քարտ՝ {identity|IDC}, {name|NAMEHY}։
Անձը հաստատող փաստաթուղթը՝ ID քարտ {identity|IDC}։ // Հանրային ծառայությունների համարանիշ՝ {identity|SSN}։ // Անձնագրի համարը՝ {identity|PASS} // Քաղաքացի {name|NAMEHY} բնակվում է {address|ADDRHY}։
Խմբագիր՝ {name|NAMEHY} ({email|EMAIL}) // Մեր զրուցակիցն էր {name|NAMEHY}։ // {name|NAMEHY} պատմել է իր մանկության մասին։ // Ըստ {name|NAMEHY} խոսքի՝ ճանապարհը բացվել է։ // Տիկին {name|NAMEHY} այստեղ է ապրում։ // Կապվել պարոն {name|NAMEHY} հետ, հեռ. {phone|PHONE}։
Ստացող՝ {name|NAMEHY}, {address|ADDRHY}, {phone|PHONE} // Վաճառվում է տուն, {address|ADDRHY}, {phone|PHONE}։ // Հանդիպումը տեղի կունենա {address|ADDRHY} հասցեում։ // Հասցեն՝ {address|ADDRHY}։ // {name|NAMEHY}, {address|ADDRHY} // {email|EMAIL} | {phone|PHONE}
Ստորագրություն՝ {name|NAMEHY} // Լուսանկարը՝ {name|NAMEHY} // Գնորդ {name|NAMEHY} խնդրում է զանգել {phone|PHONE} // Այդ մասին գրել է ընթերցող {name|NAMEHY}։ // Պահակը՝ {name|NAMEHY}, գիտի բոլորին։ // տրված {name|NAMEHY} անունով
Կարծիք է գրել {name|NAMEHY}, {email|EMAIL}։ // Կարծիք է թողել {name|NAMEHY}, {email|EMAIL} // Տիկին {name|NAMEHY} պատմեց, որ դպրոցը փակ է։ // Տիկին {name|NAMEHY} ասաց, թե գյուղը փոքր է։ // Գնորդ {name|NAMEHY} չի ստացել նամակը։ // Նամակը գրված էր այսպես՝ {name|NAMEHY}, {address|ADDRHY}։ // The tenant {name|NAMEEN} agreed to pay. // The neighbour {name|NAMEEN} came with the plan. // Նամակը ստացել է {name|NAMEHY}, {address|ADDRHY} այդ օրը նա տանը չէր։ // Ստորագրություն՝ {name|NAMEHY}, ID քարտ {identity|IDC}, {address|ADDRHY} 1919 թվականին դպրոցը փակվեց։ // Ի վերջո Լեռնավանի խանութը փակվեց։ // Նամակը հասցեագրված էր՝ {name|NAMEHY}, {address|ADDRHY}։
Call {phone|PHONE} and ask for {name|NAMEEN}. // Text me at {phone|PHONE}. // Write to {email|EMAIL} for more. // Send it to {address|ADDREN}. // I am {name|NAMEEN} and I live at {address|ADDREN}. // The applicant, {name|NAMEEN}, showed passport no. {identity|PASS}.
The tenant {name|NAMEEN} signed. // {name|NAMEEN} / {email|EMAIL} / {phone|PHONE} // {name|NAMEEN} / {email|EMAIL} // Please send a copy of identity card {identity|IDC} to {email|EMAIL}. // His social card number is {identity|SSN}. // {name|NAMEEN} / {email|EMAIL} / {phone|PHONE} // Author: {name|NAMEEN} // Deliver to {address|ADDREN}, attention {name|NAMEEN}
Телефон: {phone|PHONE}, спросить {name|NAMERU}. // Пишите на {email|EMAIL}. // Проживает по адресу: {address|ADDRRU}. // Заявитель {name|NAMERU}, паспорт {identity|PASS}. // Сдаётся дом, {address|ADDRRU}. // Соседа зовут {name|NAMERU}. // Доставка: {address|ADDRRU}, {phone|PHONE} // Номер соцкарты {identity|SSN}. // Отправьте паспорт {identity|PASS} на {email|EMAIL}. // ID-карта {identity|IDC}
Պատվեր № 004512378-20, արժեքը՝ 45 300 դրամ։ // Հաշիվ ապրանքագիր № 7712345/88 // ISBN 978-5-17-118366-8 // Ժամանակը՝ 12.05.1998, ժամը 18:30։ // Տարբերակ 3.18.2-b204 // Կոորդինատները՝ 40.1811, 44.5136։ // Չափսերը՝ 210-35-70 մմ։ // Ընդունվել է ՀՕ-27-Ն օրենքը 2003 թվականին։ // Տե՛ս https://lernavan.example/page/5512345 // Հետևեք մեզ @lernavan էջում։ // Հաշիվը՝ 78-65, 3-րդ փողոցային վազք։ // Գրանցվել է 120 450 դիմում։ // Այգեստանի փողոցը վերանորոգվել է 2001 թվականին։ // Խորենացու փողոցում նոր ծառեր տնկեցին։ // 12 ½ ² naïve
Order no. 884512-77, price 1 250. // The street was repaired in 1998. // In 1999 about 350 visitors came. // Гонка прошла по улице в 2004 году. // Цена 15 400 рублей, заказ № 5512347-12. // Գրադարանը բացվել է 1876 թվականին, երբ քաղաքապետը եկավ։ // Արև է, երկինքը պարզ է։ // Վարդ բացվեց այգում։ // Hope is never lost. // The Grant was paid in full. // Mark the page. // Violet flowers grow by the Castle wall.
Ջրաշենի և Լեռնավանի միջև ճանապարհը բացվել է 1954 թվականին։ // Լեռնավանի հին թատրոնը վաճառում էր աթոռը։ // Եթե դպրոցը կառուցում է նոր սենյակ, ապա Այգեձորի խանութը պետք է փակվի։ // «նոր դուռ» ցուցահանդեսը բացվել է Բերդավանի թանգարանում։ // Ո՛չ գիրքը, ո՛չ էլ քարտեզը չեն վաճառվում։ // Միջնադարյան արձանը վերականգնվել է։ // Գարնանային կայանը, պատմական համայնքը և պետական վարչությունը։ // Կարդալ ավելին // Կիսվել Տպել Ուղարկել
The Old Keeper Opened The Garden Near The Station. // Le vieux gardien a fermé la porte en 1905. // Der alte Wächter öffnet im Jahr 1911 das Tor. // Городской музей Открыл Новый Зал в 1962 году. // Около 640 человек видели, как мастер Построил мост. // Yesterday A Young Painter finished two heavy boxes. // def f(x): return x ** 4 // Հոդված 165. Նոր կարգ // 1) Հին կարգը 2) նոր կարգը // A. The first part. B. The second part. // в 1873 году Новый Директор купил старый дом.
"""


#: Names that the list of given names needn't hold, so that shapes and contexts are learned without it.
RARE = {
    "hy": ("Վարսենիկ Հայկանուշ Մամիկոն Տիրուհի Շուշանիկ Մաքրուհի Երանուհի Խորեն Գարեգին Պարգև Վաղինակ Ազնիվ", "Դուրգարյան Ոսկանյան Քեշիշյան Զոհրաբյան Բաբախանյան Ղուկասյան Մխիթարյան"),
    "en": ("Thaddeus Imogen Cressida Lorcan Anneliese Rajesh Fatima Nkechi Hiroshi Leopold Winifred Søren Zoë", "Blackwood Okafor Nakamura Lindqvist Fernandes Kowalski Haddad Petit Weiss Ashworth Müller Novak"),
    "ru": ("Ярослав Эльдар Тимур Лилия Захар Марфа Аркадий Ренат Платон Агата", "Кузьмичёв Ахмедов Гончаренко Стрельников Мухина Савицкая Юсупов Котляр"),
    "ka": ("ნინო დავით მარიამ ლევან თამარ ზურაბ ეკა ირაკლი", "ბერიძე კაპანაძე გელაშვილი ლომიძე ჯაფარიძე ქავთარაძე მაჭავარიანი წერეთელი"),
}
#: Lines in which a person does something or is announced, and lines of places and things in capital letters.
MORE = """
{name|NAMEEN} sent the parcel on Friday. // {name|NAMEEN} wrote the report. // {name|NAMEEN} said that the road is closed. // Our teacher was {name|NAMEEN}. // The director is {name|NAMEEN}. // The prize went to {name|NAMEEN}. // Contact: {name|NAMEEN} // Contact {name|NAMEEN}, {phone|PHONE}
Photographed by {name|NAMEEN}. // My neighbour {name|NAMEEN} works at the station. // The singer was {name|NAMEEN}. // {name|NAMEEN} lives at {address|ADDREN}. // The new manager, {name|NAMEEN}, opened the shop. // The book is signed by {name|NAMEEN}. // Director: {name|NAMEEN}
Անցյալ տարի {name|NAMEHY} երգեց թատրոնում։ // Դասը վարում էր {name|NAMEHY}։ // Համերգին {name|NAMEHY} հանդես եկավ նոր երգով։ // Գիրքը գրել է {name|NAMEHY}։ // Տնօրենը {name|NAMEHY} է։ // Նամակն ուղարկել է {name|NAMEHY}։ // Երեկ {name|NAMEHY} եկավ գյուղ։ // Մեր ուսուցիչը {name|NAMEHY} էր։
Договор подготовила {name|NAMERU}. // С нами беседовала {name|NAMERU}. // Книгу написал {name|NAMERU}. // {name|NAMERU} рассказал о городе. // Наш директор — {name|NAMERU}. // Письмо отправил {name|NAMERU}. // Вчера {name|NAMERU} пришёл домой.
დირექტორმა {name|NAMEKA} სკოლა გახსნა. // გუშინ {name|NAMEKA} სოფელში მოვიდა. // წიგნი დაწერა {name|NAMEKA}. // {name|NAMEKA} ბაღში მუშაობს. // მასწავლებელი {name|NAMEKA} კარგად ლაპარაკობს. // ძველი მეპურე დილით ადრე ადგა და პური გამოაცხო. // სკოლა და ბაღი ახლოს არის.
She moved to {address|ADDREN} last year. // Er wohnt in der {address|ADDRDE}. // Adresse: {address|ADDRDE} // Das Haus {address|ADDRDE} ist alt. // Elle habite {address|ADDRFR}. // Bureau : {address|ADDRFR} // Ring {phone|PHONE} after six. // Tel. {phone|PHONE} // WhatsApp {phone|PHONE} // Звоните: {phone|PHONE}
The Southern Lakes are cold in winter. // The Grand Hotel was sold. // The Old Market is open today. // He read about the Second World War. // New Bedford is a small town. // Silver Creek was flooded. // The Red River rose. // In Upper Valley the school was closed. // Green Park has two lakes. // Hill Crescent was closed for repairs. // The main street is long, and 12 people live there.
Նոր Գյուղ համայնքը մեծ է։ // Հին Կամուրջը փակ է։ // Հարավային պողոտան նեղ է։ // Старый Город стоит на реке. // Новый Мост закрыт. // Die Alte Brücke ist gesperrt. // Die Hauptstraße ist lang. // Article 12 of Law 31 applies. // Meeting at 11:20 on 03.05.2019. // Die Straße wurde 1998 gebaut. // Room 12 is on the third floor.
"""


def _fill(r: random.Random, slot: str) -> str:
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    if slot == "PHONE":
        op = r.choice(["10", "11", "33", "41", "43", "55", "60", "77", "91", "93", "94", "95", "96", "98", "99", "68", "79", "89"])
        if r.random() < 0.25:
            return r.choice([f"+{r.choice(['33', '44', '49', '39'])} {d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", f"+49 {d(3)} {d(8)}", f"0{op}-{d(2)}-{d(2)}-{d(2)}", f"0{op}.{d(2)}.{d(2)}.{d(2)}", f"(0{d(2)}) {d(4)} {d(4)}", f"8-9{d(2)}-{d(3)}-{d(2)}-{d(2)}", f"0{op} {d(2)} {d(2)} {d(2)}"])
        return r.choice([f"+374 {op} {d(6)}", f"+374{op}{d(6)}", f"+374 ({op}) {d(2)}.{d(2)}.{d(2)}", f"+ 374 {op} {d(3)} {d(3)}", f"00374-{op}-{d(6)}", f"0{op}{d(6)}", f"0{op} {d(2)}-{d(2)}-{d(2)}", f"(0{op}) {d(2)} {d(2)} {d(2)}", f"0{op}/{d(3)}-{d(3)}", f"+1 (555) {d(3)}-{d(4)}", f"555-{d(4)}", f"1-555-{d(3)}-{d(4)}", f"555-{d(4)} ext. {d(1)}", f"8 (9{d(2)}) {d(3)}-{d(2)}-{d(2)}", f"+7 9{d(2)} {d(3)} {d(2)} {d(2)}", f"+44 20 {d(4)} {d(4)}"])
    if slot == "EMAIL":
        user = r.choice(["anna.k", "info+petros", "office", "petros_77", "Karine-sahakyan", "levon12"])
        host = r.choice(["mail.example", "school.test", "post.example.org", "gir-hy.example", "MAIL.EXAMPLE.COM"])
        return r.choice(["{}@{}", "{}@{}", "mailto:{}@{}", "<{}@{}>", "{} (at) {}", "{}[at]{}", "{} @ {}"]).format(user, host)
    if slot == "PASS":
        return r.choice("AA AB AH AK BP KM RS TU".split()) + r.choice(["", " ", "-"]) + d(7)
    if slot == "SSN":
        return r.choice([d(10), f"{d(5)}-{d(5)}", f"{d(4)} {d(3)} {d(3)}"])
    if slot == "IDC":
        return "00" + d(7)
    lang = slot[-2:].lower()
    if slot.startswith("NAME") and (lang == "ka" or r.random() < 0.35):
        given, sur = (r.choice(x.split()) for x in RARE[lang])
        if lang == "hy":
            sur += r.choice(["", "", "ի", "ը", "ն"])
        return r.choice([f"{given} {sur}", f"{given} {sur}", f"{sur} {given}", *([] if lang == "ka" else [f"{given[0]}. {sur}", f"{given[0]}. {sur}", f"{given} {sur.upper()}"])])
    if slot == "ADDRDE":
        return r.choice("Linden Garten Schul Kirch Berg Mühlen Bahnhof".split()) + r.choice(["straße", "straße", "gasse", "weg", "allee"]) + f" {r.randint(1, 140)}"
    if slot == "ADDRFR":
        return f"{r.randint(1, 140)}{r.choice(['', ','])} {r.choice(['rue', 'rue', 'avenue', 'boulevard', 'quai'])} {r.choice(['des Roses', 'du Moulin', 'de la Gare', 'Pasteur', 'des Tilleuls'])}"
    if slot.startswith("NAME"):
        given, sur = r.choice(GIVEN[lang].split()), r.choice(SURNAMES[lang].split())
        if lang == "hy":
            sur += r.choice(["", "", "", "ի", "ին", "ը"])
        if lang == "hy" and r.random() < 0.2:
            from kaghamar.llm.langid import romanised

            given, sur = romanised(given).capitalize(), romanised(sur).capitalize()
        style = r.random()
        form = r.choice([f"{given} {sur}", f"{given} {sur}", f"{sur} {given}", f"{given[0]}. {sur}", f"{given[0]}. {r.choice('ԱԳՄՍ' if lang == 'hy' else 'AGMS')}. {sur}", f"{sur} {given[0]}."])
        return form.upper() if style < 0.12 else f"{sur.upper()} {given}" if style < 0.2 else f"{given} {sur.upper()}" if style < 0.24 else form.lower() if style < 0.3 and lang != "en" and ". " not in form else form
    n, m = r.randint(1, 140), r.randint(1, 120)
    house = r.choice([str(n), str(n), f"{n}/{r.randint(1, 9)}"])
    street = r.choice(STREETS[lang].split())
    if lang == "hy":
        town = r.choice(["", "", r.choice(TOWNS) + ", ", "ք. " + r.choice(TOWNS) + ", "])
        return town + r.choice([f"{street} փող. {house}", f"{street} փողոց {house}, բն. {m}", f"{street} փողոցի թիվ {house} տանը", f"{street} պողոտա, {house} տուն", f"{street} փ., շենք {house}, բնակարան {m}", f"{street} նրբանցք {house}", f"{street} խճուղի {house}"])
    if lang == "ru":
        return r.choice([f"ул. {street}, д. {house}, кв. {m}", f"улица {street}, {house}", f"{street} ул., дом {house}", f"ул. {street}, {house}", f"пр. {street}, д. {house}"])
    if r.random() < 0.3:
        return f"{house} {street} {r.choice('Crescent Way Place Terrace Close Court Gardens'.split())}"
    return r.choice([f"{house} {street} Street", f"{house} {street} Rd., Apt {m}", f"{house} {street} Lane, Flat {m}", f"{house} {street} Avenue"])


#: Running text that may stand before or after an item on the same line.
BESIDE = """
Եթե դպրոցը կառուցում է նոր սենյակ, ապա Այգեձորի խանութը պետք է փակվի։ // 1919 թվականին խանութը փակել է Լեռնավանի դարպասը։ // Այսօր Բերդավանի տնօրենը գնում է հին գրքեր։ // Միջնադարյան պալատը պահպանվել է. այդ մասին գրում են թերթերը։ // Հաճախ ջրի գինը բարձրանում է։ // Վաղ առավոտից Ջրաշենի խանութը բաց էր։ // այդ մասին գրում էր թերթը։
The old keeper opened the garden near the station. // About 640 visitors noticed the new wall. // In 1911 a young painter finished two boxes. // Yesterday our keeper sold the map. // Старый сторож вчера закрыл сад. // Около 640 человек видели новый мост. // В 1911 году директор купил дом. // Der alte Wächter öffnet das Tor. // Hier, notre voisin a fermé la porte.
"""


def labelled(rounds: int = 12, seed: int = 5) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """(line, [(begin, end, kind)]) of the filled templates."""
    r = random.Random(seed)
    lines = [x.strip() for x in (TEMPLATES + MORE).replace("\n", " // ").split(" // ") if x.strip()]
    out = []
    for turn in range(rounds):
        for line in lines:
            if "{" not in line and turn > 2:
                continue
            beside = [x.strip() for x in BESIDE.replace("\n", " // ").split(" // ") if x.strip()]
            text, spans, at = "", [], 0
            if r.random() < 0.25:
                text = r.choice(beside).rstrip("." * (r.random() < 0.3)) + " "
            for m in re.finditer(r"\{(\w+)\|(\w+)\}", line):
                text += line[at : m.start()]
                item = _fill(r, m[2])
                spans.append((len(text), len(text) + len(item), m[1]))
                text += item
                at = m.end()
            tail = " " + r.choice(beside) if r.random() < 0.3 else ""
            out.append(((text + line[at:]).rstrip("։." if tail and r.random() < 0.5 else "") + tail, spans))
    return out
