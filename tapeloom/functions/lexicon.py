"""Patterns, word lists and thresholds that results depend on, as plain text."""

from __future__ import annotations

# speech of the interviewer: quotations that rule it out, strong marks, weak marks
QUOTATION = [r"\bтак и сказал\b", r"\bвот и сказал\b", r"\b(сказал|ответил|заявил|отметил|приказал|распорядился)\b.*\b(что|чтобы|нет|да)\b", r"\b(товарищ|командир|генерал|маршал|капитан|полковник)\s+\w+\s+(сказал|ответил|приказал|заявил)\b", r"\bкак\s+(он|они|мне|нам|ему|им)\s+(сказал|ответил|говорил)\b", r"\b(говорил|говорили|твердил|утверждал|утверждали|заявлял)\b", r"\bцитирую\b", r"\bпо\s+его\s+словам\b", r"\bпо\s+их\s+словам\b", r"\bдавайте\s+(я|мы|еще|ещё)\b"]
STRONG = [r"\bрасскажите\b", r"\bобъясните\b", r"\bкак\s+вы\b", r"\bпочему\s+вы\b", r"\bчто\s+вы\b", r"\bсмотрим\b"]
WEAK = [r"\bвы\s+", r"\bдавайте\b"]
CONTEXT_WORDS = 100
CONTINUATION_SPLIT = [r"^то\s+есть\b", r"^в\s+частности\b", r"^кроме\s+того\b", r"^также\b", r"^иными\s+словами\b", r"^другими\s+словами\b", r"^более\s+того\b", r"^помимо\s+этого\b", r"^при\s+этом\b", r"^однако\b", r"^тем\s+не\s+менее\b", r"^впрочем\b"]
CONTINUATION_CLASSIFY = [r"^то\s+есть\b", r"^в\s+частности\b", r"^кроме\s+того\b", r"^помимо\s+этого\b", r"^также\b", r"^более\s+того\b", r"^к\s+тому\s+же\b", r"^вдобавок\b", r"^при\s+этом\b", r"^однако\b", r"^но\b", r"^а\s+(?:также|еще|ещё)\b"]
ANNOUNCEMENT = [r"следующий вопрос\s+(про|о|об)", r"еще вопрос\s+(про|о|об)", r"другой вопрос\s+(про|о|об)"]
ANNOUNCEMENT_WIDE = [*ANNOUNCEMENT, r"дальше вопрос\s+(про|о|об)"]
ANNOUNCEMENT_WORDS = 20
COMMANDS = ["давайте", "смотрим", "представьтесь", "расскажите", "объясните", "покажите", "повторите"]
QUESTION = [r"\?$", r"^первый вопрос", r"^второй вопрос", r"^третий вопрос", r"^\d+[-й\s]+вопрос", r"^расскажите", r"^объясните", r"^как\s+", r"^почему\s+", r"^что\s+", r"^каков", r"^в\s+чем"]
CONFIRMATION = [r"^ну\s+да", r"^да[-,\s]", r"^да\.", r"^угу", r"^ага", r"^мм[-\s]?хм", r"^верно", r"^правильно", r"^точно", r"^именно", r"^конечно", r"^хорошо$", r"^ладно$"]
SPLIT_COMMANDS = [r"\bне\s+переговорите\b", r"\bпереговорите\b", r"\bповторите\b", r"\bеще\s+раз\b", r"\bс\s+начала\b", r"\bзаново\b"]

# speech of the expert, beside the expert's surname
EXPERT = [r"\bя\s+(считаю|думаю|полагаю)\b", r"\bна\s+мой\s+взгляд\b", r"\bпо\s+моему\s+мнению\b"]
# introductions of the expert, beside the surname
INTRODUCTION = [r"меня\s+зовут", r"профессор", r"доктор\s+(наук|исторических)", r"кандидат\s+(наук|исторических)"]
# the first words of a camera operator and of an interviewer
OPERATOR_FIRST = r"(?:камера\s+(?:идет|идёт|пошла)|поехали|пишем|начали|записываем|камера(?:\s|$)|запись)"
JOURNALIST_FIRST = r"(?:\d+\s+вопрос|первый\s+вопрос|второй\s+вопрос|третий\s+вопрос|представьтесь?\s+пожалуйста|как\s+вас\s+будут\s+расписывать|мы\s+сейчас\s+отвечаем\s+на\s+вопросы|у\s+нас\s+сериал|тема\s+нашего|представляетесь|расскажите?|опишите|объясните|что\s+вы\s+(?:думаете|считаете)|как\s+вы\s+(?:думаете|считаете))\b|\?$"

# words without weight of their own, for the merge of replicas and its guards
MERGE_STOP = "был была было были буду будет будут будем будете бывает есть быть в во на с со к ко по из за до при через об о у для от под над про без между среди и а но или что как если когда где чтобы потому тоже также либо ни хотя зато однако вот же ли бы ну не да то так лишь только даже уж я ты он она оно мы вы они меня тебя его её ее нас вас их мне тебе ему ей нам вам им это этот эта эти там тут здесь тогда уже еще ещё очень совсем весьма".split()
# prepositions after which nothing is cut off
HANGING = "на в во с со к по из за до при через о об у для от под над".split()

# weighted evidence of who speaks: (side, pattern, weight)
SCORES = [
    ("j", r"\b(расскажите|объясните|поясните|уточните|скажите)\b", 3), ("j", r"\b(вы\s+(?:можете|знаете|помните|считаете|думаете))\b", 2), ("j", r"\b(как\s+вы\s+(?:считаете|думаете|оцениваете))\b", 3), ("j", r"\bпредставьтесь\b", 5), ("j", r"\b(давайте|переходим|начнем|продолжим)\b", 2),
    ("j", r"\?$", 1), ("j", r"^(как|почему|зачем|когда|где|кто|что)\s", 2), ("j", r"\b(не\s+так|верно|правильно)\s*\?", 2), ("j", r"\b(смотрим|слушаем|отвечаем)\s+(?:на|в)", 2), ("j", r"\bмы\s+(?:сейчас|теперь)\s+(?:отвечаем|говорим|обсуждаем)\b", 2),
    ("s", r"\b(у\s+меня|мне|я\s+(?:считаю|думаю|полагаю|помню))\b", 2), ("s", r"\b(на\s+мой\s+взгляд|по\s+моему\s+мнению)\b", 3), ("s", r"\b(моё|моя|мой|мои)\s+(?:мнение|опыт|исследование|работа)\b", 3), ("s", r"\b\d{4}\s*год", 1), ("s", r"\b(?:операция|сражение|битва|фронт|армия)\b", 1),
    ("s", r"\bмы\s+(?:сейчас|теперь|тут|здесь)\s", -3), ("s", r"\bвы\s+(?:представьтесь|расскажите|объясните)\b", -5),
]
FLIP_DIFFERENCE = 3

# boilerplate that recognition invents at the end and at the beginning
ENDINGS = [r"продолжение\s+следует[.!?]*\s*$", r"спасибо\s+за\s+внимание[.!?]*\s*$", r"до\s+новых\s+встреч[.!?]*\s*$", r"подписывайтесь\s+на\s+наш\s+канал[.!?]*\s*$", r"ставьте\s+лайки[.!?]*\s*$", r"untertitelung\s+des\s+zdf[^.]*[.!?]*\s*$", r"untertitel\s+von\s+[^.\n]*[.!?]*\s*$", r"vielen\s+dank\s+fürs\s+zuschauen[.!?]*\s*$", r"bis\s+zum\s+nächsten\s+mal[.!?]*\s*$", r"untertitel\s+im\s+auftrag[^.\n]*[.!?]*\s*$"]
LEADINGS = [r"^\s*untertitelung\s+des\s+zdf[^.]*[.!?,]*\s*", r"^\s*untertitel\s+von\s+[^.\n]*[.!?,]*\s*", r"^\s*untertitel\s+im\s+auftrag[^.\n]*[.!?,]*\s*", r"^\s*copyright\s+[^\n]*[.!?,]*\s*"]

# vocabulary cleaning
STOP = "я ты он она оно мы вы они мой твой его её наш ваш их этот эта это эти тот та то те такой такая такое такие весь вся всё все каждый любой другой сам и а но или да же ли не ни если чтобы когда как что где куда хотя пока также тоже либо однако тем чем нежели в на по из от до для при через под над между перед после во со ко без у около вокруг против среди ради благодаря согласно вопреки несмотря очень так еще уже только даже лишь почти совсем вполне едва чуть слишком более менее самый наиболее наименее потом затем тогда теперь сейчас снова опять вновь всегда никогда иногда часто".split()
STOP_TEMPLATES = ["дата", "противники", "итог", "командующие", "силы сторон", "потери", "см. также", "см.", "также", "примечания", "источники", "ссылки", "литература", "комментарии", "содержание", "медиафайлы на викискладе", "медиафайлы", "викискладе", "основной конфликт", "ход операции", "итоги операции", "состав", "численность", "вооружение", "результат"]
STARTERS = "был была было были стал стала стали начал начала начались пошел пошла пошли мне мною меня тебе тобой тебя ему ей им нам вам только уже еще всё так теперь тогда одновременно немедленно внезапно".split()
REJECT = [r"^\d+$", r"^[a-zA-Z\s]+$", r"[<>{}()\[\]]", r"https?://", r"^[^\p{L}\p{N}_]+$", r"\b(напомнил|приходилось|поинтересовался|улыбнулся|пишут|писал|говорил|сказал|ответил|спросил|видел|слышал|знал|думал|считал|полагал|надеялось|продолжал|продолжали|оказывал|оказывали|принял|вскоре|встревожило|изумило|вызывал|доложил|сообщал|сообщила|вышли|гласила)\b"]
ENGLISH_DATE = [r"\b\d{1,2}\s+(January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{4}\b", r"\b\d{1,2}\s+(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\s+\d{4}\b"]
GENITIVE = ["ии", "ий", "ия", "ей", "ов", "ев", "ам", "ям", "ах", "ях"]
COUNTRIES = "германии италии франции польши румынии венгрии австрии чехословакии югославии финляндии норвегии швеции испании".split()
VERB_MARKS = "был была было были стал начал пошел имел мог должен может".split()

# white-list of hot words
WHITE_STOP = "я ты он она оно мы вы они мой твой его её наш ваш их этот тот такой весь сам самый и а но да или либо то если что как чтобы когда пока хотя словно будто в на с к по из о у от до за над под при про через без для ради между не ни бы ли же ведь вот даже лишь только очень здесь там так где куда откуда всегда никогда часто редко можно нужно надо".split()
RANKS = "маршал генерал полковник подполковник майор капитан лейтенант сержант ефрейтор рядовой командир командующий начальник".split()
UNIT = r"^\d+-[яйе]\s+(дивизия|бригада|полк|батальон|рота|взвод|армия|корпус|фронт|флот|эскадра)"
TECHNICAL = r"^[А-ЯЁ][а-яё]*-\d+$|^[A-Z][a-z]+-[A-Z][a-z]+-?\d*$"
TOPONYM = ["град", "бург", "полье", "ладожье", "поволжье", "ский", "ская", "ское", "ино", "ово", "ево"]
VERBS_INSIDE = [r"\b(был|были|была|было)\b", r"\b(начал|начала|начали|начало)\b", r"\b(стал|стала|стали|стало)\b", r"\b(мог|могла|могли|могло)\b", r"\b(имел|имела|имели|имело)\b"]

# audit of addresses
PRIORITY_HIGH = ["pamyat-naroda.ru", "podvignaroda.ru", "obd-memorial.ru", "militera.lib.ru", "rkka.ru", "iremember.ru"]
PRIORITY_MED = ["ru.wikipedia.org", "en.wikipedia.org", "warspot.ru", "histrf.ru", "armedman.ru"]
JS_DOMAINS = ["warspot.ru", "waralbum.ru", "allaces.ru"]
API_DOMAINS = ["pamyat-naroda.ru", "podvignaroda.ru"]
MANUAL_DOMAINS = ["t.me", "telegram.me"]
CHAPTER_LINK = r"^([a-zA-Z]*\d+|chapter\d*|part\d*|text\d*)\.html?$"
URL_PATTERN = r"https?://[^\s\]>\"'<\)]+"
WEIGHT_BANDS = [(0.5, 5), (0.2, 4), (0.05, 3), (0.01, 2)]
VAD_STEPS = [(300, 0.65), (600, 0.70), (900, 0.75)]

# cases of names and formations, brought back to the nominative one rule after the other: (pattern, replacement)
CASE_ENDINGS = [
    (r"(?<=\w)ского\b", "ский"), (r"(?<=\w)скому\b", "ский"), (r"(?<=\w)ским\b", "ский"), (r"(?<=\w)ском\b", "ский"), (r"(?<=\w)ской\b", "ская"), (r"(?<=\w)скую\b", "ская"), (r"(?<=\w)ского\b", "ское"),
    (r"(?<=\w)ного\b", "ный"), (r"(?<=\w)ному\b", "ный"), (r"(?<=\w)ным\b", "ный"), (r"(?<=\w)ном\b", "ный"), (r"(?<=\w)ной\b", "ная"), (r"(?<=\w)ную\b", "ная"),
    (r"\bарми(?:и|ю|ей|е|й)\b", "армия"), (r"\bфронта?\b", "фронт"), (r"\bфронт(?:у|ом|е)\b", "фронт"), (r"\bкорпус[ауоме]\b", "корпус"), (r"\bдивизи(?:и|ю|ей|е|й)\b", "дивизия"), (r"\bбригад[ыеуойою]\b", "бригада"),
    (r"\bполк[ауоме]\b", "полк"), (r"\bбатальон[ауоме]\b", "батальон"), (r"\bфлот[ауоме]\b", "флот"), (r"\bокруг[ауоме]\b", "округ"), (r"\bштаб[ауоме]\b", "штаб"),
    (r"([А-ЯЁ][а-яё]{3,})ого\b", r"\1"), (r"([А-ЯЁ][а-яё]{3,})ому\b", r"\1"), (r"([А-ЯЁ][а-яё]{3,})ым\b", r"\1"), (r"([А-ЯЁ][а-яё]{3,})ом\b", r"\1"), (r"([А-ЯЁ][а-яё]{3,})ему\b", r"\1"), (r"([А-ЯЁ][а-яё]{3,})ем\b", r"\1"),
]
