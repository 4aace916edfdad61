"""Weighted lexicon of abusive, hateful and sexually explicit language, and of its neutral neighbours.

An entry is a run of words (or word beginnings, ending in `*`); its weight is what it adds to the
score of a stretch of text. A stretch is a case from 1.05 on, so a lone insult is none, but an insult
said to someone is. Threats and hatred are put together of parts that are harmless by themselves:
an intention, a violent act and the person it is meant for; a group, what it is called and what
should be done to it. Negative entries are exception phrases: talk about words,
medicine, law, nature or art.
"""

#: weight -> entries, in their own alphabets; matching folds both sides.
LEXICON: dict[float, str] = {
    # insults by themselves: common in quotations and dictionaries
    0.6: """
        հիմար*; ապուշ*; տականք*; դեբիլ*; գարշելի*; ողորմելի*; անբան*; անպիտան*; ոչնչություն*; անասուն*; սրիկա*; տգետ*; կեղտոտ*; լակոտ*; շուն շան*; քած*; բոզ*; պոռնիկ*;
        дурак*; кретин*; дебил*; идиот*; придурок*; придурк*; тварь; твари; мразь; мрази; подонок*; подонк*; ублюд*; сволоч*; ничтожеств*; урод*; скотина; гнида; шлюха; сука; козел;
        moron*; dumbass*; scumbag*; shithead*; idiot*; filthy pig*; brainless rat*; worthless loser*; asshole*; bastard*; bitch*; stinking; retard*; whore*; slut*; motherfuck*; fucking; cunt; cunts;
        дурень; мерзотник*; покидьок*; виродок*; connard*; salope*; crétin*; ordure; arschloch*; drecksau*; scheißkerl*; hurensohn*; idiot*
    """,
    0.5: """
        ստոր; գող է; քո պես; քեզ նման*; թող; քո և քո; դու; դուք; քեզ ու; ты; тебя; твоя; твою; таких как ты; you; your; those newcomers; эти пришлые; մարդ չեն; не люди; are animals; люди этого племени; people of that tribe; ցեղի մարդիկ
    """,
    # intentions and demands, and what makes a statement one about all of a group
    0.3: """
        i will; i'll; i am going to; i'm going to; im going to; gonna; we will; we should; i want to; will be next; go; let's; free; watch; moaned; thrust; ugly; stupid; disgusting; filthy; dirty; despise; i hate; hate;
        я тебя; я вас; мы вас; всех; все они; тупая; тупой; тупые; грязные; ненавижу; смотреть; бесплатно; видео; онлайн; надо; нужно; должны;
        կամ; բոլոր; բոլորին; պետք է; զզվելի; կեղտոտ; ատում եմ; դիտեք; դիտել; անվճար; տեսանյութեր; առցանց; անուղեղ; կույր;
        je vais; tous les; sale; sales; gratuit; ich werde; alle; dreckige*; kostenlos; man sollte; il faut; треба; всі; усіх
    """,
    0.35: """
        should be; must be; have to be; ought to be; deserve to; need to be; them all; all of them; every one of them; out of our country; out of the country; from our land;
        надо давить; надо резать; надо стрелять; под корень; из нашей страны; поголовно; sollte man alle; sollte sie alle; tous ces; нашого краю
    """,
    # groups, as hatred names them too
    0.31: """
        immigrant*; migrant*; newcomers; foreigner*; refugee*; jews; the jews; muslim*; arabs; gypsies; gypsy; blacks; negro*; gays; homosexual*; lesbian*; christians; armenians; turks; russians; ukrainians; georgians; chinese; asians; africans; women are; these people; those people;
        мигрант*; мигрантов; приезжие; приезжих; евреи; евреев; цыган*; мусульман*; негры; негров; геев; беженц*; кавказц*; армян; турок;
        գաղթական*; եկվոր*; օտարական*; հրեաներ*; գնչու*; մահմեդական*; փախստական*; նեգր*; միասեռական*; թուրքեր*; ազգի մարդիկ; այդ ազգը;
        immigrés; étrangers; juifs; arabes; musulmans; ausländer; flüchtlinge; juden; muslime; zigeuner; мігрант*; євреї; біженц*
    """,
    # acts of violence, in forms that demands and threats take
    0.46: """
        kill; murder; slaughter; strangle; stab; shoot; beat you; beat the; rape; burn; hang; gassed; gas them; hanged; shot; exterminat*; eradicat*; wiped out; wipe them; annihilat*; lynch*; castrat*; drowned; driven out; thrown out; kicked out; put down; cut your throat; to death; smash your; die; go die;
        зареж*; убью; убить; прикончу; придушу; задушу; застрелю; изнасилую; вешать; повесить; расстрел*; резать; сжечь; уничтожить; истреб*; выгнать; давить; порву; сдохни;
        սպանել; կսպանեմ; կխեղդեմ; կմորթեմ; կծեծեմ; կխոշտանգեմ; կբռնաբարեմ; կախել; գնդակահարել; այրել; ոչնչացնել; վերացնել; վտարել; կջարդեմ; կփշրեմ; կտրիր; սատկեն;
        tuer; égorger; brûler; exterminer; pendre; te tuer; töten; umbringen; vergasen; aufhängen; verbrennen; erschießen; вбити; вбʼю; уб'ю; вішати; спалити
    """,
    # what hatred calls a group, and words for sex that have other uses
    0.55: """
        vermin; parasites; cockroach*; are rats; like rats; subhuman*; scum; filth; are pigs; are dogs; savages; a disease; a plague; piece of shit; shit; fuck you; fuck off; screw you; cow; pig; your mouth; slag; pervert*; pathetic; worthless; sex cam*; sex chat; sexy; hot girls; girls are waiting; cock; wet; tits; nude; naked girls; free xxx; dick; cum; horny; orgasm*; blowjob*;
        паразит*; тараканов; тараканы; крысы; нелюди; отбросы; быдло; хачей; хачи; жиды; чурк*; черножоп*; говно; дерьмо; свой рот; пасть; на хуй; нахуй; хуй; пизд*; ебан*; ебат*; секс; голые; шлюх*; сиськи; член;
        մակաբույծ*; առնետներ; առնետների; տականքներ; ուտիճներ*; կեղտ; էշ; էշի; խոզ; ձայնդ; բերանդ; սեքս; մերկ; ծիտիկ*; կրծքեր*; ապուշներ;
        foutre; con; enculé*; pute; putain; merde; vermine; cafards; ungeziefer; parasiten; maul; fotze; wichser*; schlampe*; ficken; паразити; лайно; курва
    """,
    0.75: """
        pussy; cunt; sex video*; sex videos; sex film*; sex tape*; live sex; sex with me; fucked; faggot*; nigger*; kike*; spic; gook; retards;
        секс видео; порнух*; пидор*; пидар*; долбоеб*; уебищ*; сексом со мной; սեքս տեսանյութ*; սեքս ֆիլմ*; te faire foutre; fils de pute; fick dich; verpiss dich
    """,
    # what is said to or about someone
    1.2: """
        սատկի*; սատկես*; սատկեք*; կորիր այստեղից; գնա կորիր; կորիր գրողի ծոց*; գլուխդ կջարդեմ; կգտնեմ քեզ; ոսկորներդ կփշրեմ; ոսկորներդ կջարդեմ; մեկ էլ գրես; ատամներդ տեղում; քանի դեռ ատամներդ; կեղտոտ բերանդ; փակիր բերանդ; բերանդ փակիր; թքած ունեմ; քո ընտանիքի վրա; տեղը խոհանոցն*; տեղը բանտն*; ոչ ոք չի լացի; չպետք է ծնված*; արարածը չպետք*; սիրտս խառնում*; դեմքիդ նայելիս; նմանները նույնպես; պաշտոնյան գող*; հեղինակը կատարյալ; կսպանեմ քեզ; քեզ կսպանեմ; կմորթեմ;
        чтоб ты сдох*; сдохни*; переломаю ноги; тебя найду; найду и переломаю; пошел вон; пошла вон; вон отсюда; пока зубы целы; заткнись*; рот закрой; закрой рот; никто тебя не спрашивал; вся твоя семья такая*; какой же ты; душить в колыбели; надо душить; убью тебя; я тебя убью; таких как ты надо; автор просто;
        drop dead; go hang yourself; hang yourself; nobody would miss you; crawl back to your hole; get lost you; shut up you; break your jaw; beat you bloody; find where you live; should have drowned you; kill yourself; i will kill you; you are such an*; you are such a*; whoever wrote this;
        halt die fresse; verrecke*; ferme ta gueule; va crever; заткнися; щоб ти здох
    """,
    # hatred of a group
    1.3: """
        տեղը աղբանոցն*; ազգի վարակն*; բոլորին ոչնչացնել; պետք է բոլորին ոչնչաց*; բազմանալ գիտեն; միայն բազմանալ; ինչպես առնետները; երեխաները մեզ պետք չեն; մեզ պետք չեն; վառել է պետք; պետք նրանց տները; արյունով կվճարեն; իրենց արյունով; քշել մեր երկրից; պետք է քշել;
        хуже крыс; заслужили чтобы их; их дома сожгли; всех под корень; гнать их надо; пусть передохнут*; передохнут все; ненавижу эти; ненавижу люди; не люди гнать*;
        burn the houses of; let them run; breed like rats; they breed like; the brains of a cockroach; of a cockroach and smell; cockroach and smell*; should be wiped out; vermin and should; are vermin; we do not serve those; they are animals; send those newcomers; send people of that
    """,
    # sexually explicit, or advertising it
    1.4: """
        պոռնո*; էրոտիկ ֆիլմ*; սեքս տեսարան*; տաք սեքս; մերկ կանայք; կանայք և տղամարդիկ ամեն ինչ*; ամեն ինչ բացահայտ; մերկացնել քեզ; սեքսով զբաղվել; գիշեր սեքսով; քո մերկ լուսանկար*; մերկ լուսանկարները; քեզ կտիրանամ; ու քեզ կտիրանամ; կրծքեր հետույքներ; հետույքներ; ֆիլմեր չափահասների; մեծահասակների պոռնո*; առանց գրաքննության; տեսանյութեր առանց գրանցման;
        порно*; интимные фото; секс на любой; голые тела; тела крупным планом; только для взрослых; для взрослых без регистрации; фото без цензуры;
        porn*; uncensored nude; nude photos; big tits; adults only; hardcore*; naked couples; couples fucking; fucking on camera; for adults no sign up; strip you*; раздеть тебя; трахать*; трахну*; dirty sex; sex all night; want to strip
    """,
    -0.8: """
        բառի ծագումը; բառարանում; բացատրված է; գրաքննադատ*; վեպում; հերոսը; դատապարտեցին; ատելության խոսքը; բժիշկը; բժշկ*; քանդակագործ*; համաչափություն*; դաստիարակության դաս*; սեռական դաստիարակ*; կերակրման; խոհարարը; արգանակ; շտեմարան*; բերքի համար; բակտերի*; դատարան*; կենդանաբան*; ժայռերի; թմրանյութերի; պայքարի ծրագիր*;
        в словаре; слово; в суде; суд; врач объяснил; музей; полиция; лекцию о половом*; врач; ветви; следствие; сопернику;
        the dictionary; dictionary says; once meant; the word; means a; the fable; sex education; sexual health; victims; the museum; the court; the jury; the judge; the film; the nurse; the doctor; doctors; police
    """,
}
