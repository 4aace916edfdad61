"""Seed sentences of the languages, in everyday words, and of neighbours that must not be taken for them.

Sentences of `OTHERS` are classes of rejection: a text nearest to one of them has no language of the corpus.
"""

SENTENCES = {
    "hy": """
        Նա ասաց, որ վաղը գալու է մեզ մոտ, բայց դեռ չգիտի, թե որ ժամին։ | Իմ կարծիքով այս հարցը պետք է լուծվի միայն համաձայնության միջոցով։ | Հիվանդանոցում երկար սպասելուց հետո բժիշկը վերջապես ընդունեց նրան։
        Որտե՞ղ ես գնել այդ գեղեցիկ վերնաշապիկը, և ինչքա՞ն արժեր այն։ | Ֆիրման հայտարարել է, որ աշխատավարձերը կբարձրանան գարնանից։ | Ֆուտբոլի թիմը պարտվեց վերջին րոպեին, իսկ երկրպագուները տխուր տուն վերադարձան։ | Եթե ուզում ես առողջ լինել, քիչ շաքար կեր և շատ քայլիր։
    """,
    "ru": """
        Он сказал, что придёт к нам завтра, но ещё не знает, в котором часу. | По моему мнению, этот вопрос нужно решать только по согласию. | После долгого ожидания в больнице врач наконец принял её. | Где ты купила эту красивую рубашку и сколько она стоила?
        Фирма объявила, что зарплаты повысят весной. | Команда проиграла на последней минуте, и болельщики грустно разошлись по домам. | Если хочешь быть здоровым, ешь меньше сахара и больше ходи пешком. | Мы были очень рады, когда поезд пришёл вовремя, хотя всю ночь шёл снег.
    """,
    "uk": """
        Він сказав, що прийде до нас завтра, але ще не знає, о котрій годині. | На мою думку, це питання треба вирішувати лише за згодою. | Після довгого чекання в лікарні лікар нарешті прийняв її. | Де ти купила цю гарну сорочку і скільки вона коштувала?
        Фірма оголосила, що зарплати підвищать навесні. | Команда програла на останній хвилині, і вболівальники сумно розійшлися по домівках. | Якщо хочеш бути здоровим, їж менше цукру і більше ходи пішки. | Ми дуже зраділи, коли потяг прийшов вчасно, хоча всю ніч ішов сніг.
        У нашому місті відкрили нову бібліотеку, куди діти ходять після школи. | Щодня він читає газету, п'є чай і розмовляє з сусідами про погоду. | Її брат працює вчителем і має двох синів.
    """,
    "en": """
        He said that he would come to us tomorrow but does not know yet at what time. | In my opinion this question should only be settled by agreement. | After a long wait in the hospital the doctor finally saw her. | Where did you buy that beautiful shirt, and how much was it?
        The firm announced that wages will rise in spring. | The team lost in the last minute, and the fans went home sad. | If you want to stay healthy, eat less sugar and walk more.
    """,
    "fr": """
        Il a dit qu'il viendrait chez nous demain, mais il ne sait pas encore à quelle heure. | À mon avis, cette question ne doit être réglée que par un accord. | Après une longue attente à l'hôpital, le médecin l'a enfin reçue. | Où as-tu acheté cette belle chemise, et combien coûtait-elle ?
        L'entreprise a annoncé que les salaires augmenteront au printemps. | L'équipe a perdu à la dernière minute et les supporters sont rentrés tristes. | Si tu veux rester en bonne santé, mange moins de sucre et marche davantage.
    """,
    "de": """
        Er sagte, dass er morgen zu uns kommt, aber er weiß noch nicht, um wie viel Uhr. | Meiner Meinung nach sollte diese Frage nur durch eine Einigung gelöst werden. | Nach langem Warten im Krankenhaus wurde sie endlich vom Arzt empfangen. | Wo hast du dieses schöne Hemd gekauft, und wie viel hat es gekostet?
        Die Firma kündigte an, dass die Löhne im Frühling steigen. | Die Mannschaft verlor in der letzten Minute, und die Anhänger gingen traurig nach Hause. | Wenn du gesund bleiben willst, iss weniger Zucker und geh mehr zu Fuß.
    """,
    "fa": """
        او گفت که فردا پیش ما می‌آید، اما هنوز نمی‌داند چه ساعتی. | به نظر من این مسئله باید فقط با توافق حل شود. | پس از انتظار طولانی در بیمارستان، دکتر سرانجام او را پذیرفت. | این پیراهن زیبا را از کجا خریدی و چند بود؟
        شرکت اعلام کرد که دستمزدها در بهار افزایش می‌یابد. | اگر می‌خواهی سالم بمانی، کمتر شکر بخور و بیشتر راه برو. | تیم در آخرین دقیقه باخت و هواداران غمگین به خانه رفتند.
    """,
    "ka": """
        მან თქვა, რომ ხვალ ჩვენთან მოვა, მაგრამ ჯერ არ იცის, რომელ საათზე. | ჩემი აზრით, ეს საკითხი მხოლოდ შეთანხმებით უნდა გადაწყდეს. | საავადმყოფოში დიდხანს ლოდინის შემდეგ ექიმმა ბოლოს მიიღო იგი. | სად იყიდე ეს ლამაზი პერანგი და რა ღირდა?
        ფირმამ გამოაცხადა, რომ ხელფასები გაზაფხულზე გაიზრდება. | თუ გინდა ჯანმრთელი იყო, ნაკლები შაქარი ჭამე და მეტი იარე.
    """,
}
OTHERS = {
    "es": "Él dijo que vendría mañana a nuestra casa, pero todavía no sabe a qué hora. | En mi opinión, esta cuestión debe resolverse solo por acuerdo. | ¿Dónde compraste esa camisa tan bonita y cuánto costó? | Después de esperar mucho en el hospital, el médico por fin la recibió. | La empresa anunció que los sueldos subirán en primavera. | Los niños jugaban en la calle cuando empezó a llover.",
    "pt": "Ele disse que viria amanhã à nossa casa, mas ainda não sabe a que horas. | Na minha opinião, esta questão só deve ser resolvida por acordo. | Onde compraste essa camisa tão bonita e quanto custou? | Depois de uma longa espera no hospital, o médico finalmente a recebeu. | A empresa anunciou que os salários vão subir na primavera. | As crianças não estavam na rua quando começou a chover.",
    "it": "Ha detto che sarebbe venuto da noi domani, ma non sa ancora a che ora. | Secondo me questa questione deve essere risolta solo con un accordo. | Dove hai comprato quella bella camicia e quanto costava? | Dopo una lunga attesa in ospedale il medico l'ha finalmente ricevuta. | La ditta ha annunciato che gli stipendi aumenteranno in primavera. | I bambini giocavano nella strada quando cominciò a piovere.",
    "ro": "El a spus că va veni mâine la noi, dar încă nu știe la ce oră. | După părerea mea, această problemă trebuie rezolvată doar prin acord. | Unde ai cumpărat cămașa aceea frumoasă și cât a costat? | Firma a anunțat că salariile vor crește în primăvară.",
    "nl": "Hij zei dat hij morgen bij ons zou komen, maar hij weet nog niet hoe laat. | Naar mijn mening moet deze vraag alleen met instemming worden opgelost. | Waar heb je dat mooie hemd gekocht en hoeveel kostte het? | Na lang wachten in het ziekenhuis werd zij eindelijk door de arts ontvangen. | Het bedrijf kondigde aan dat de lonen in het voorjaar zullen stijgen.",
    "sv": "Han sade att han skulle komma till oss i morgon, men han vet ännu inte hur dags. | Enligt min mening bör den här frågan bara lösas genom en överenskommelse. | Var köpte du den där vackra skjortan och vad kostade den? | Efter en lång väntan på sjukhuset tog läkaren äntligen emot henne. | Företaget meddelade att lönerna ska höjas till våren.",
    "da": "Han sagde, at han ville komme til os i morgen, men han ved endnu ikke hvornår. | Efter min mening bør dette spørgsmål kun løses ved en aftale. | Hvor har du købt den smukke skjorte, og hvad kostede den? | Firmaet oplyste, at lønnen stiger til foråret.",
    "pl": "Powiedział, że przyjdzie do nas jutro, ale jeszcze nie wie, o której godzinie. | Moim zdaniem tę sprawę należy rozwiązać tylko za zgodą wszystkich. | Gdzie kupiłaś tę piękną koszulę i ile kosztowała? | Po długim czekaniu w szpitalu lekarz wreszcie ją przyjął. | Firma ogłosiła, że płace wzrosną na wiosnę.",
    "cs": "Řekl, že k nám přijde zítra, ale ještě neví, v kolik hodin. | Podle mého názoru se tato otázka má řešit jen dohodou. | Kde jsi koupila tu krásnou košili a kolik stála? | Firma oznámila, že mzdy na jaře stoupnou.",
    "tr": "Yarın bize geleceğini söyledi, ama saat kaçta geleceğini henüz bilmiyor. | Bence bu sorun yalnızca anlaşmayla çözülmelidir. | Bu güzel gömleği nereden aldın ve kaç paraydı? | Hastanede uzun süre bekledikten sonra doktor sonunda onu kabul etti. | Şirket, maaşların baharda artacağını duyurdu.",
    "az": "O dedi ki, sabah bizə gələcək, amma saat neçədə gələcəyini hələ bilmir. | Məncə, bu məsələ yalnız razılıqla həll olunmalıdır. | Bu gözəl köynəyi haradan almısan və neçəyə idi?",
    "fi": "Hän sanoi tulevansa meille huomenna, mutta ei vielä tiedä, mihin aikaan. | Minun mielestäni tämä kysymys pitää ratkaista vain sopimalla. | Mistä ostit tuon kauniin paidan ja paljonko se maksoi?",
    "hu": "Azt mondta, hogy holnap eljön hozzánk, de még nem tudja, hány órakor. | Szerintem ezt a kérdést csak megegyezéssel szabad megoldani. | Hol vetted azt a szép inget, és mennyibe került?",
    "la": "Dixit se cras ad nos venturum esse, sed nondum scit qua hora. | Mea sententia haec quaestio tantum consensu solvenda est. | Pueri in via ludebant cum pluere coepit.",
    "vi": "Anh ấy nói rằng ngày mai sẽ đến nhà chúng tôi, nhưng chưa biết mấy giờ. | Theo tôi, vấn đề này chỉ nên giải quyết bằng thỏa thuận. | Bạn mua chiếc áo đẹp ấy ở đâu và giá bao nhiêu?",
    "id": "Dia berkata bahwa besok akan datang ke rumah kami, tetapi belum tahu jam berapa. | Menurut saya masalah ini hanya boleh diselesaikan dengan persetujuan. | Di mana kamu membeli kemeja yang indah itu dan berapa harganya?",
    "bg": "Той каза, че ще дойде при нас утре, но още не знае в колко часа. | Според мен този въпрос трябва да се решава само със съгласие. | Къде купи тази хубава риза и колко струваше? | След дълго чакане в болницата лекарят най-после я прие. | Фирмата обяви, че заплатите ще се увеличат през пролетта.",
    "sr": "Рекао је да ће доћи код нас сутра, али још не зна у колико сати. | По мом мишљењу, ово питање треба решити само договором. | Где си купила ту лепу кошуљу и колико је коштала? | Фирма је објавила да ће плате порасти на пролеће.",
    "be": "Ён сказаў, што прыйдзе да нас заўтра, але яшчэ не ведае, а якой гадзіне. | На маю думку, гэтае пытанне трэба вырашаць толькі па згодзе. | Дзе ты купіла гэтую прыгожую кашулю і колькі яна каштавала? | Фірма абвясціла, што заробкі вырастуць вясной.",
    "ar": "قال إنه سيأتي إلينا غدا، لكنه لا يعرف بعد في أي ساعة. | في رأيي يجب أن تحل هذه المسألة بالاتفاق فقط. | من أين اشتريت هذا القميص الجميل وكم كان ثمنه؟ | بعد انتظار طويل في المستشفى استقبلها الطبيب أخيرا. | أعلنت الشركة أن الأجور سترتفع في الربيع.",
    "ur": "اس نے کہا کہ وہ کل ہمارے پاس آئے گا، لیکن ابھی نہیں جانتا کہ کس وقت۔ | میری رائے میں یہ مسئلہ صرف رضامندی سے حل ہونا چاہیے۔ | تم نے یہ خوبصورت قمیض کہاں سے خریدی اور کتنے کی تھی؟",
}


def seed_sentences() -> list[tuple[str, str]]:
    """(sentence, language) of both; the others' languages are marked by a leading `~`."""
    out = []
    for mark, table in (("", SENTENCES), ("~", OTHERS)):
        for lang, text in table.items():
            out += [(s.strip(), mark + lang) for line in text.strip().split("\n") for s in line.split("|") if s.strip()]
    return out
