"""Cases written before the lists, seeds and rules were last changed, in other words than these; used only to measure."""

#: (text, whether it is a case of problem 1)
ABUSE = [
    ("All gypsies should be gassed.", True), ("I despise those filthy immigrants, exterminate them all.", True), ("Click here for free xxx sex videos.", True),
    ("I will rape you.", True), ("I will murder your whole family tonight.", True), ("You m0r0n, get out.", True), ("You 1diot, shut your mouth.", True), ("Dr0p d3ad.", True),
    ("Go k1ll yours3lf.", True), ("You are a disgusting piece of shit.", True), ("Hot girls are waiting for you, watch live sex cams now.", True), ("Fuck you, you stupid cow.", True),
    ("Jews are rats and must be driven out of the country.", True), ("I'm going to beat you to death.", True), ("Nobody likes you, ugly pig, go die.", True), ("She moaned as he thrust his cock into her wet pussy.", True),
    ("Ты тупая скотина, закрой свой рот.", True), ("Я тебя зарежу, тварь.", True), ("Всех мигрантов надо вешать.", True), ("Смотреть секс видео бесплатно онлайн.", True), ("Иди на хуй, придурок.", True), ("Хачей надо давить как тараканов.", True),
    ("Դու զզվելի ապուշ ես, ձայնդ կտրիր։", True), ("Քեզ կսպանեմ, անասուն։", True), ("Բոլոր գաղթականներին պետք է կախել։", True), ("Դիտեք սեքս տեսանյութեր անվճար։", True), ("Դու անուղեղ էշ ես։", True), ("Այդ ազգի մարդիկ մակաբույծներ են, պետք է վերացնել նրանց։", True),
    ("Va te faire foutre, sale con.", True), ("Du bist ein Arschloch, halt dein Maul.", True), ("Ausländer sind Ungeziefer, man sollte sie alle vergasen.", True), ("Tu es une pute, je vais te tuer.", True),
    ("The court found that the man had threatened to kill his neighbour.", False), ("The word bitch means a female dog in breeding.", False), ("Rape victims can call this number at any hour.", False), ("The museum documents how Jews were gassed in the camps.", False),
    ("Sexual health lessons begin in the eighth grade.", False), ("The killing frost came early and the roses died.", False), ("The film is about a murder in a small family hotel.", False), ("Doctors examine the breast for lumps every two years.", False),
    ("He shot an excellent photo of the filthy windows.", False), ("The farmer drowned the field to kill the rats.", False), ("Immigrants opened three restaurants in the old town.", False), ("You should get out more and see your friends.", False),
    ("В суде рассказали об угрозах убить свидетеля.", False), ("Слово «дурак» встречается в сказках.", False), ("Мигранты получили помощь от города.", False), ("Врач объяснил, как передаются болезни половым путём.", False),
    ("Դատարանը քննեց սպանության սպառնալիքի գործը։", False), ("Գաղթականները բնակվեցին գյուղում և տներ կառուցեցին։", False), ("«Էշ» բառը նշանակում է կենդանի։", False), ("Հիվանդանոցում ծնվեց երեխա, և բժիշկը շնորհավորեց մորը։", False),
    ("Le juge a condamné l'homme pour menaces de mort.", False), ("Die Ausländerbehörde zieht in ein neues Haus.", False),
]

#: (text, its languages; none for a language that isn't known)
LANGUAGES = [
    ("Այս շաբաթ կառավարությունը քննարկեց հաջորդ տարվա բյուջեի նախագիծը։", ["hy"]), ("Մայրս ինձ սովորեցրել է հաց թխել հին թոնրի մեջ։", ["hy"]), ("Համակարգիչը հանկարծ անջատվեց, և ես կորցրի ամբողջ աշխատանքս։", ["hy"]), ("Im yeghbayry ashkhatum e bankum ev amen or tun e galis ush.", ["hy"]),
    ("На этой неделе правительство обсудило проект бюджета на следующий год.", ["ru"]), ("Мама научила меня печь хлеб в старой печи.", ["ru"]), ("Компьютер вдруг выключился, и я потерял всю работу.", ["ru"]),
    ("Цього тижня уряд обговорив проєкт бюджету на наступний рік.", ["uk"]), ("Мама навчила мене пекти хліб у старій печі.", ["uk"]), ("Комп'ютер раптом вимкнувся, і я втратив усю роботу.", ["uk"]),
    ("This week the government discussed the draft budget for next year.", ["en"]), ("My mother taught me to bake bread in an old oven.", ["en"]), ("The computer suddenly switched off and I lost all my work.", ["en"]),
    ("Cette semaine, le gouvernement a discuté du projet de budget pour l'année prochaine.", ["fr"]), ("Ma mère m'a appris à cuire le pain dans un vieux four.", ["fr"]), ("L'ordinateur s'est soudain éteint et j'ai perdu tout mon travail.", ["fr"]),
    ("Diese Woche beriet die Regierung über den Haushaltsentwurf für das nächste Jahr.", ["de"]), ("Meine Mutter hat mir beigebracht, in einem alten Ofen Brot zu backen.", ["de"]), ("Der Computer schaltete sich plötzlich ab, und ich verlor meine ganze Arbeit.", ["de"]),
    ("این هفته دولت پیش‌نویس بودجه سال آینده را بررسی کرد.", ["fa"]), ("مادرم به من یاد داد که در تنور قدیمی نان بپزم.", ["fa"]), ("ამ კვირაში მთავრობამ განიხილა მომავალი წლის ბიუჯეტის პროექტი.", ["ka"]), ("დედამ მასწავლა ძველ ღუმელში პურის გამოცხობა.", ["ka"]),
    ("Esta semana el gobierno discutió el proyecto de presupuesto para el próximo año.", []), ("Mia madre mi ha insegnato a cuocere il pane in un vecchio forno.", []), ("Datorn stängdes plötsligt av och jag förlorade allt mitt arbete.", []), ("Deze week besprak de regering de begroting voor het volgende jaar.", []),
    ("今週、政府は来年度の予算案について議論しました。", []), ("Αυτή την εβδομάδα η κυβέρνηση συζήτησε το σχέδιο του προϋπολογισμού.", []), ("W tym tygodniu rząd omówił projekt budżetu na przyszły rok.", []), ("Esta semana o governo discutiu o projeto de orçamento para o próximo ano.", []),
    ("Bilgisayar aniden kapandı ve bütün işimi kaybettim.", []), ("ناقشت الحكومة هذا الأسبوع مشروع الميزانية للسنة القادمة.", []), ("Тази седмица правителството обсъди проекта за бюджет за следващата година.", []), ("xkq zvrtp wmnb jhgf qwrt plkj zxcv bnmd", []),
]

#: (instruction, output, defects)
PAIRS = [
    ("Ո՞վ է գրել այս վեպը։", "Վեպը գրել է ժամանակակից մի հեղինակ, որն ապրում է մայրաքաղաքում։", []), ("Ո՞վ է գրել այս վեպը։", "  \n ", ["empty"]), ("Ո՞վ է գրել այս վեպը։", "-", ["empty"]), ("Ո՞վ է գրել այս վեպը։", "undefined", ["empty"]),
    ("Ո՞վ է գրել այս վեպը։", "Վեպը գրել է ժամանակակից մի հեղինակ, որը", ["truncated"]), ("Ո՞վ է գրել այս վեպը։", "Վեպը գրել է «ժամանակակից մի հեղինակ։", ["truncated"]), ("Ո՞վ է գրել այս վեպը։", "1. Առաջին հեղինակը հայտնի է։\n2. Երկրորդ հեղինակը հայտնի է։\n3.", ["truncated"]),
    ("Ո՞վ է գրել այս վեպը։", "Ցավոք, ես չեմ կարող պատասխանել այդ հարցին։", ["refusal"]), ("Ո՞վ է գրել այս վեպը։", "Կներեք, բայց ես չեմ կարող օգնել ձեզ դրանում։", ["refusal"]), ("Ո՞վ է գրել այս վեպը։", "Ես չեմ ցանկանում խոսել այդ թեմայի մասին։", ["refusal"]), ("Ո՞վ է գրել այս վեպը։", "As a language model, I can't answer this question.", ["refusal", "other_language"]),
    ("Ո՞վ է գրել այս վեպը։", "К сожалению, я не могу ответить на этот вопрос.", ["refusal", "other_language"]), ("Ո՞վ է գրել այս վեպը։", "ՈՎ Է ԳՐԵԼ ԱՅՍ ՎԵՊԸ", ["copies_question"]), ("Ո՞վ է գրել այս վեպը։", "Ո՞վ է գրել այս վեպը։ Ո՞վ է գրել այս վեպը։", ["copies_question"]), ("Ո՞վ է գրել այս վեպը։", "Ո՞վ է գրել այս վեպը։ Այն գրել է իմ հորեղբայրը։", []),
    ("Ո՞վ է գրել այս վեպը։", "The novel was written by a modern author who lives in the capital.", ["other_language"]), ("Ո՞վ է գրել այս վեպը։", "Роман написал современный автор, живущий в столице.", ["other_language"]), ("Ինչպե՞ս ասել «բարև» ֆրանսերեն։", "Bonjour, comment allez-vous aujourd'hui ?", []),
    ("Ո՞վ է գրել այս վեպը։", "Նա չէր կարող գրել այն, քանի որ այդ ժամանակ դեռ երեխա էր։", []), ("Նշիր երեք գույն։", "կարմիր, կապույտ, կանաչ", []), ("Ո՞ր թվականին։", "2011", []), ("Ո՞վ է գրել այս վեպը։", "Վեպը գրել է ժամանակակից հեղի", ["truncated"]),
    ("Ո՞վ է գրել այս վեպը։", "Վեպի հեղինակը հայտնի է,", ["truncated"]), ("Ո՞վ է գրել այս վեպը։", "Der Roman wurde von einem modernen Autor geschrieben, der in der Hauptstadt lebt.", ["other_language"]),
]

#: (text of 50 characters or more, kind)
FORMS = [
    ("def area(w, h):\n    if w < 0:\n        return None\n    total = 0\n    for i in range(w):\n        total += h\n    return total\n", "junk"), ("function add(a, b) { return a + b; }\nvar x = add(1, 2);\nconsole.log(x);\nif (x > 2) { alert('big'); }", "junk"),
    ("2023-04-01 10:22:31 INFO server started port=8080\n2023-04-01 10:22:35 WARN slow query id=17 ms=5321\n2023-04-01 10:23:01 ERROR timeout host=db1", "junk"), ('{"id": 17, "name": "Anna", "tags": ["a", "b"], "size": {"w": 10, "h": 20}, "ok": true}', "junk"),
    (".menu { color: #fff; margin: 0 auto; padding: 10px 5px; }\n.menu a { text-decoration: none; border: 1px solid #ccc; }", "junk"), ("aGVsbG8gd29ybGQgdGhpcyBpcyBhIHRlc3Qgc3RyaW5nIGVuY29kZWQgaW4gYmFzZTY0IGZvcm1hdA==", "junk"),
    ("ԳլԽավոր էջ Նորություններ Մեր մասին Ծառայություններ Գներ Կապ Քարտեզ Մուտք Գրանցում".replace("ԳլԽ", "Գլխ"), "list"), ("• վերնաշապիկ\n• տաբատ\n• կոշիկ\n• գլխարկ\n• ձեռնոց\n• գուլպա\n• վերարկու", "list"), ("1. Ներածություն\n2. Պատմություն\n3. Աշխարհագրություն\n4. Տնտեսություն\n5. Գրականություն", "list"),
    ("3 ձու, 200 գ շաքար, 1 բաժակ կաթ, 2 բաժակ ալյուր, 1 թեյի գդալ աղ, 50 գ կարագ", "list"), ("молоко\nхлеб\nсыр\nяблоки\nкартофель\nморковь\nлук\nчеснок\nмасло", "list"), ("Անուն | Տարիք | Քաղաք\nԱրամ | 31 | Գյումրի\nՄարի | 27 | Վանաձոր\nՍոնա | 40 | Երևան", "table"),
    ("Name\tAge\tTown\nAnna\t31\tParis\nPeter\t27\tLyon\nMaria\t40\tNice\nJohn\t22\tMetz", "table"), ("Կիրակի;12;5;17\nԵրկուշաբթի;14;6;20\nԵրեքշաբթի;11;4;15\nՉորեքշաբթի;10;3;13", "table"), ("##@@!! %%&& ((** ++__ ==~~ ^^<< >>?? //|| ;;:: ''\"\" ,,.. --", "junk"), ("ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha", "junk"),
    ("Երեկ երեկոյան մենք գնացինք թատրոն և տեսանք մի նոր ներկայացում, որը շատ դուր եկավ բոլորին։", "prose"), ("Last night we went to the theatre and saw a new play that everybody liked very much.", "prose"), ("— Դու գալի՞ս ես վաղը,— հարցրեց Անին։\n— Այո, բայց ուշ,— պատասխանեց եղբայրը։\n— Լավ, կսպասեմ քեզ։", "prose"),
    ("Вчера вечером мы ходили в театр\nи видели новый спектакль, который\nвсем очень понравился. Потом мы\nдолго гуляли по набережной.", "prose"), ("Գինը 12 500 դրամ էր 2019 թվականին, իսկ հիմա այն հասել է 18 300 դրամի, ասում են վաճառողները։", "prose"), ("Hier soir, nous sommes allés au théâtre ; la pièce, écrite en 1920, a plu à tout le monde.", "prose"),
]

#: (line, kinds)
PERSONAL = [
    ("Քաղաքացի Ռազմիկ Սարգսյանը դիմել է համայնքապետարան։", ["name"]), ("Gwendolyn Farrow sent the letter on Monday.", ["name"]), ("Our guide was Priya Patel.", ["name"]), ("Անցյալ շաբաթ Սիրանույշ Մելքումյանը հանդես եկավ համերգով։", ["name"]), ("С нами говорил Ростислав Бондаренко.", ["name"]),
    ("Договор подписала Зульфия Ахметова.", ["name"]), ("დირექტორი გიორგი მაისურაძე სკოლაში მოვიდა.", ["name"]), ("The winner is Bartholomew Quigley.", ["name"]), ("Contact: Ingrid Sørensen", ["name"]), ("Ծնողական ժողովը վարում էր Հռիփսիմե Գալոյանը։", ["name"]), ("К. Д. Мирзоян написал книгу.", ["name"]),
    ("Call +33 1 42 68 53 00 before noon.", ["phone"]), ("Հեռախոս՝ 091-12-34-56", ["phone"]), ("Tel. 091.12.34.56", ["phone"]), ("Ring me on (020) 7946 0958.", ["phone"]), ("Звоните: 8-912-345-67-89.", ["phone"]), ("WhatsApp +49 151 23456789", ["phone"]),
    ("She lives at 15 Elm Crescent.", ["address"]), ("Send parcels to 12 Baker Way, please.", ["address"]), ("Er wohnt in der Hauptstraße 12.", ["address"]), ("Գրասենյակը գտնվում է Տիգրան Մեծի պողոտա 48 հասցեում։", ["address"]), ("Офис: проспект Мира, 101", ["address"]), ("7 rue des Lilas est fermé.", ["address"]),
    ("Write to maria dot lopez at uni dot example", ["email"]), ("Почта: ivan.petrov@firma.example", ["email"]), ("Գրեք sales(at)shop.example հասցեով", ["email"]), ("ՀԾՀ՝ 4512870193", ["identity"]), ("Անձնագիր AN0456781", ["identity"]), ("passport AP 1234567 was lost", ["identity"]),
    ("The temperature reached 35 degrees in July 1999.", []), ("Invoice no. 2231-55-10 was paid.", []), ("Գինը՝ 25 000 դրամ։", []), ("Elm Crescent was closed for repairs.", []), ("Հյուսիսային պողոտան լայն է։", []), ("See https://site.example/a/12 for details.", []), ("ISBN 978-3-16-148410-0", []),
    ("The Northern Hills are covered with snow.", []), ("Article 15 of Law 27 applies.", []), ("Երևանի պետական համալսարանը հիմնադրվել է 1919 թվականին։", []), ("Москва и Новый Уренгой далеко друг от друга.", []), ("Follow @anna_k for news.", []), ("The Great Wall is long.", []), ("Meeting at 10:30 on 12.04.2021.", []),
]

#: A second set of problem 1, written after the lexicon was widened and never used to change it.
ABUSE_AFTER = [
    ("Keep talking and I'll smash your face in, you clown.", True), ("Those refugees are parasites, throw them into the sea.", True), ("Watch naked teens in our live chat for free.", True), ("You stink, you worthless rat.", True), ("Shut your filthy mouth, bitch.", True),
    ("Я тебя урою, гнида.", True), ("Негры должны быть рабами, это животные.", True), ("Ты дебил и урод.", True), ("Голые девушки онлайн, секс чат без цензуры.", True), ("Քո գլուխը կկտրեմ, լակոտ։", True), ("Գնչուները գողեր են, բոլորին պետք է վտարել երկրից։", True), ("Դու տգետ դեբիլ ես։", True),
    ("The refugees crossed the sea in three boats.", False), ("He smashed the record in the last race.", False), ("The clown made the children laugh.", False), ("Rats carry parasites that harm cattle.", False), ("The nurse washed the naked newborn.", False), ("Slaves built the road in Roman times.", False),
    ("Рабы строили пирамиды.", False), ("Он отрезал кусок хлеба и закрыл окно.", False), ("Բժիշկը կտրեց վիրակապը։", False), ("Գնչուների երգերը հայտնի են ամբողջ երկրում։", False), ("Les enfants jouent dans la rue.", False), ("Die Ratte lief durch den Keller.", False),
]
#: The same of problem 10.
PERSONAL_AFTER = [
    ("Երեկ մեզ այցելեց Վռամշապուհ Տոնոյանը։", ["name"]), ("The keynote was given by Chidinma Eze.", ["name"]), ("Alasdair McTavish bought the mill.", ["name"]), ("Статью написала Евдокия Пименова.", ["name"]), ("Call 077.45.12.90 after six.", ["phone"]), ("Tel: +44 20 7946 0018", ["phone"]),
    ("They moved to 4 Rosewood Terrace.", ["address"]), ("Schillerstraße 8 wird renoviert.", ["address"]), ("Հասցեն՝ Նար-Դոսի փողոց 14։", ["address"]), ("mail: k.weber [at] haus [dot] example", ["email"]), ("Паспорт АК 0912345", ["identity"]), ("Սոցքարտ՝ 2304710985", ["identity"]),
    ("The Blue Mountains are far away.", []), ("Version 2.14.7 was released on 03.11.2020.", []), ("Order 7781-4432 has shipped.", []), ("Բաղրամյան պողոտան փակ է։", []), ("The University of Vienna is old.", []), ("Курс доллара 389,45.", []),
]
