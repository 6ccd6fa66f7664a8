"""Trains models/residue.json: python -m tapeloom.llm.train_residue /root/testdata/sf0.1

A softmax over hashed word stems, letter trigrams, pairs of stems and the shape
of a statement.  Its labels come from two written teachers: example statements
(``EXAMPLES``: messages, filler, furniture and statements that only tell of such
things, in Russian, English, German, Spanish and French), and pattern rules
(``teach``) on the statements of at most SAMPLE documents, which know the
matter of this project.  The operator itself holds no list of either.
"""

from __future__ import annotations

import json
import re
import sys
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq

from tapeloom.llm import residue as r

SAMPLE, EPOCHS, STATEMENTS = 10_000, 12, 40_000

# Statements of servers, programs, sites and browsers, and filler.
_MESSAGE = [
    r"(?:включит|включён|разрешит|активируйт|отключен)\w*\s.{0,40}(?:javascript|скрипт|сценари|cookie)", r"(?:javascript|скрипт\w*|сценари\w*)\s.{0,25}(?:отключ|включит|разрешит)", r"^для работы (?:сайта|приложения|страницы)",
    r"^включите их и обновите", r"плеер не поддерживается", r"подтвердите, что вы (?:не робот|человек)", r"^(?:запрашиваем\w+ |эта |данная )?(?:страница|документ|файл|раздел|ресурс|запись|материал|сайт)\b.{0,30}?(?:не найден\w*|удал[её]н\w*|перемещ\w+|не существует|на реконструкции|в разработке|недоступ\w+|не загружен\w*)(?:[ ,].{0,40})?[.!]?$",
    r"^вернитесь на главную", r"^(?:сервис|сервер|сайт|служба)\b.{0,20}(?:недоступ\w+|не отвечает|перегружен)\b(?!.*(?:посыльн|штаб))", r"браузер (?:устарел|не поддерживается)", r"не удалось (?:распознать|загрузить|открыть|прочитать|подключиться|соединиться)",
    r"^(?:текст[ ,]*){3,}", r"домен не обслуживается", r"слишком много запросов", r"^(?:повторите|попробуйте)(?: попытку)? через", r"попробуйте (?:позже|ещё раз|снова)", r"внутренняя ошибка", r"ошибка (?:\d{3}|соединения с базой|подключения|сервера|базы данных)", r"^(?:\d{3}\.? )?доступ (?:запрещ[её]н|закрыт|ограничен)\.?$", r"обратитесь к администратор",
    r"^здесь (?:будет|появится|должен быть)", r"^(?:текст|материал|описание|статья|содержание)\b.{0,15}(?:появится|готовится|будет добавлен)", r"^(?:описание|текст|содержание|аннотация|информация) (?:отсутству\w+|не заполнен\w*)[.!]?$", r"^(?:под)?заголовок (?:раздела|статьи|страницы)[.!]?$", r"тестов\w+ (?:запись|страница|статья|текст)", r"рыбный текст|текст-рыба", r"^пример (?:абзаца|текста|заголовка)", r"срок действия (?:сессии|ссылки) ист", r"сесси\w+ (?:истекла|завершена)", r"проверяем ваш", r"^(?:раздел|сайт|страница) (?:в разработке|на реконструкции)",
    r"enable (?:javascript|scripts|cookies)", r"(?:scripts?|javascript) (?:is|are) (?:disabled|blocked|required)", r"browser (?:is (?:out of date|outdated|not supported)|before access)", r"session has expired", r"too many (?:requests|connections)", r"service (?:is )?(?:temporarily )?unavailable", r"try again later", r"bad gateway|gateway time-?out", r"^(?:error )?\d{3}\.? (?:not found|forbidden|internal server error)", r"^(?:page|file|document) not found", r"requested (?:url|page|file)", r"^access (?:is )?denied\W*$", r"^reference #", r"under construction", r"sample paragraph|placeholder text|filler text", r"text goes here", r"test post", r"error establishing|database connection", r"internal server error", r"traceback \(most recent", r"^(?:warning|fatal error|notice|exception)\b.{0,4}[:(]", r"in /?\S+\.(?:php|py|asp) on line", r"lorem ipsum", r"you are (?:not )?a (?:robot|human)", r"coming soon\W*$", r"replace me\W*$",
    r"aktivieren sie (?:javascript|cookies)", r"kein roboter", r"blindtext", r"hier (?:steht|entsteht|folgt)", r"seite (?:ist )?(?:im aufbau|nicht gefunden|in bearbeitung)", r"sitzung ist abgelaufen", r"^zugriff verweigert\W*$", r"dienst ist (?:zur zeit|derzeit|momentan) nicht", r"browser wird nicht", r"^fehler \d{3}", r"beispielabsatz|beispieltext", r"interner serverfehler|datenbankverbindung", r"zu viele anfragen", r"(?:bitte )?(?:später|nochmals) (?:erneut )?versuchen|versuchen sie es später", r"bitte ersetzen\W*$",
]
_LATIN = "lorem|ipsum|dolor|sit|amet|consectetur|adipiscing|elit|sed|eiusmod|tempor|incididunt|labore|magna|aliqua|etium|ablor|quenda|velia|temporo|monto|porta|vendi|aptus|mirus|calor|carpen|sidum|nosmet|fugra|sutis|elitas"
# Furniture of sites.
_FURNITURE = [
    r"^[\d .,:]+$", r"^(?:января|февраля|марта|апреля|мая|июня|июля|августа|сентября|октября|ноября|декабря|januar|februar|märz|april|mai|juni|juli|august|september|oktober|november|dezember|january|february|march|may|june|july|october|december)[ \d.,]*$", r"\s\|\s", r"©|\(c\)", r"все права", r"rights reserved", r"alle rechte", r"сайт работает с", r"счётчик", r"последнее обновление|last updated|letzte änderung", r"дизайн и поддержка|webdesign|design by", r"нашли ошибку|выделите её|сообщите нам", r"при перепечатке|nachdruck nur|reprint only|reproduction only", r"^(?:главная|форум|вход|поиск|контакты?|ссылки|home|links|search|log in|contact|startseite|suche|kontakt|impressum)\W*$",
]
# Terms that messages are made of, by their stems.
_CUE = r"сайт|сервер|браузер|страниц|доступ|ошибк|запрос|сесси|скрипт|javascript|плеер|хостинг|домен|робот|файл|соединени|загруз|обновит|server|browser|page|request|error|session|script|access|gateway|unavailable|robot|seite|zugriff|sitzung|dienst|fehler|load|click|нажмите|войдите|anmelden|login"
# Terms of the domain, by their stems.
_DOMAIN = r"штаб|полк|батальон|бригад|дивизи|рота|роты|роту|арми|насып|мост|бо[йяюе]\b|приказ|архив|дневник|журнал|шифр|посыльн|гарнизон|снаряд|переправ|участ|музе|сражен|писар|донесен|сноск|плане|order|bridge|company|border|sector|diary|clerk|карт|akte|formular|blatt|kompanie|anlage|учени|озер"

EXAMPLES = {
    r.MESSAGE: """
Oops! Something went wrong.|We could not find the page you were looking for.|This page isn't available right now.|Sorry, we can't find that page.|The requested resource could not be located on this server.|404 Not Found|403 Forbidden|500 Internal Server Error|502 Bad Gateway|503 Service Unavailable|504 Gateway Timeout|The server is temporarily unable to service your request due to maintenance downtime or capacity problems.|Please try again later.|You don't have permission to access this resource.|Access denied.|Your connection is not private.|Please verify you are a human.|Complete the security check to access this site.|Checking if the site connection is secure.|Please turn JavaScript on and reload the page.|You need to enable JavaScript to run this app.|This site requires cookies to be enabled.|Your browser does not support the video tag.|Please upgrade your browser.|Your session has timed out, please log in again.|Too many requests, slow down.|Rate limit exceeded.|Error establishing a database connection|Could not connect to database.|Fatal error: Uncaught exception in /var/www/index.php on line 12|Warning: include(): failed to open stream in /home/site/config.php|Notice: Undefined variable: title in /srv/app/page.php on line 3|Traceback (most recent call last):|NullPointerException at com.example.Main.main(Main.java:42)|Segmentation fault (core dumped)|Connection refused.|Connection timed out.|The operation could not be completed.|An unexpected error has occurred.|An error occurred while processing your request.|This content is no longer available.|This account has been suspended.|This domain is for sale.|Website is under construction.|Coming soon.|Under maintenance, we will be back shortly.|Default web page.|It works!|Welcome to nginx!|Index of /|Sample text|This is a sample page.|Your text goes here.|Insert text here.|Add your content here.|Description goes here.|No description available.|Hello world!|Test test test|This is placeholder text.|Click to edit this text.|Edit this paragraph.|Loading, please wait.|No results found.|Redirecting, please wait.|You are being redirected.|If you are not redirected automatically, click here.|The link you followed has expired.|Invalid request.|Missing parameter.|Bad request.|Unauthorized.|Payment required to view this content.|Please log in to continue.|Subscribe to read the full article.|We use cookies to improve your experience.|File could not be loaded.|The file is damaged and could not be opened.|Error code 1020.|Ray ID|Unable to load model.|An internal server error was encountered.|This video is unavailable.|The image cannot be displayed.
Упс! Что-то пошло не так.|Мы не смогли найти эту страницу.|Запрашиваемая страница не существует.|Такой страницы нет.|Страница удалена или никогда не существовала.|Ошибка 404|Ошибка 403: доступ запрещён|Ошибка 500, внутренняя ошибка сервера|Сервер временно недоступен.|Сайт временно не работает, ведутся технические работы.|Ведутся профилактические работы, зайдите позже.|Попробуйте обновить страницу или зайдите позже.|Повторите попытку позже.|У вас нет прав для просмотра этого раздела.|Доступ к ресурсу ограничен.|Для просмотра необходимо авторизоваться.|Войдите или зарегистрируйтесь, чтобы продолжить.|Включите JavaScript в настройках браузера.|В вашем браузере отключён JavaScript.|Ваш браузер не поддерживает видео.|Обновите браузер до последней версии.|Для корректной работы сайта включите cookies.|Мы используем файлы cookie.|Подтвердите, что запросы отправляли вы, а не робот.|Введите символы с картинки.|Проверка браузера перед входом на сайт.|Превышено число запросов, подождите.|Время ожидания истекло.|Соединение разорвано.|Не удалось подключиться к серверу.|Не удалось загрузить страницу.|Не удалось загрузить данные, проверьте подключение к интернету.|Ошибка подключения к базе данных.|Произошла непредвиденная ошибка.|Произошла ошибка при обработке запроса.|Сообщите об ошибке администратору сайта.|Сессия устарела, выполните вход заново.|Ссылка недействительна или устарела.|Аккаунт заблокирован.|Домен продаётся.|Срок регистрации домена истёк.|Хостинг не оплачен.|Сайт находится в разработке.|Раздел в стадии наполнения.|Страница в разработке, скоро открытие.|Материал готовится к публикации.|Здесь скоро появится текст.|Тут будет текст.|Введите текст.|Текст по умолчанию.|Пример текста для проверки.|Тестовая запись.|Тест тест тест|Проба пера, проверка связи.|Рыбный текст для заполнения макета.|Здравствуй, мир!|Описание скоро появится.|Описания нет.|Нет данных.|Данные отсутствуют.|Ничего не найдено.|По вашему запросу ничего не найдено.|Загрузка, подождите.|Идёт загрузка.|Сейчас вы будете перенаправлены.|Нажмите здесь, если перенаправление не произошло.|Файл повреждён.|Файл не найден или удалён.|Видео недоступно.|Изображение не загружено.|Контент недоступен в вашем регионе.|Неверный запрос.|Вернуться на главную страницу.|Перейдите на главную или воспользуйтесь поиском.|Извините за неудобства.|Приносим извинения за временные неудобства.|Запись удалена автором.|Заголовок страницы|Название статьи|Подзаголовок|Код ошибки 502.|Неизвестная ошибка.|Модель не загружена.|Не удалось распознать речь.
Ups! Da ist etwas schiefgelaufen.|Die gesuchte Seite wurde nicht gefunden.|Diese Seite existiert nicht mehr.|Die angeforderte Seite konnte nicht geladen werden.|Seite nicht verfügbar.|Fehler 404|Fehler 500: Interner Serverfehler|Der Server ist momentan nicht erreichbar.|Die Webseite befindet sich im Wartungsmodus.|Wegen Wartungsarbeiten vorübergehend nicht erreichbar.|Bitte versuchen Sie es später noch einmal.|Zugriff verweigert.|Sie haben keine Berechtigung für diese Seite.|Bitte melden Sie sich an, um fortzufahren.|Bitte aktivieren Sie JavaScript in Ihrem Browser.|JavaScript ist deaktiviert.|Ihr Browser wird nicht unterstützt.|Ihr Browser ist veraltet, bitte aktualisieren Sie ihn.|Bitte lassen Sie Cookies zu.|Wir verwenden Cookies.|Bitte bestätigen Sie, dass Sie kein Roboter sind.|Zu viele Anfragen.|Zeitüberschreitung der Anfrage.|Verbindung fehlgeschlagen.|Keine Verbindung zur Datenbank.|Es ist ein unbekannter Fehler aufgetreten.|Bei der Verarbeitung ist ein Fehler aufgetreten.|Ihre Sitzung ist abgelaufen, bitte neu anmelden.|Dieser Link ist abgelaufen.|Diese Domain steht zum Verkauf.|Hier entsteht eine neue Internetpräsenz.|Seite im Aufbau.|Demnächst verfügbar.|Dies ist ein Blindtext.|Beispieltext, bitte ersetzen.|Hier steht Ihr Text.|Überschrift einfügen.|Keine Beschreibung vorhanden.|Der Inhalt ist nicht mehr verfügbar.|Keine Ergebnisse gefunden.|Wird geladen.|Sie werden weitergeleitet.|Die Datei konnte nicht geöffnet werden.|Datei nicht gefunden.|Video nicht verfügbar.|Ungültige Anfrage.|Zurück zur Startseite.|Hallo Welt!|Testseite|Testeintrag
Página no encontrada.|Lo sentimos, la página que busca no existe.|Error interno del servidor.|Servicio no disponible temporalmente.|Inténtelo de nuevo más tarde.|Acceso denegado.|Active JavaScript en su navegador para continuar.|Su navegador no es compatible.|Su sesión ha caducado.|Demasiadas solicitudes.|Demuestre que no es un robot.|Sitio en construcción.|Texto de ejemplo.|Error de conexión con la base de datos.
Page introuvable.|La page demandée n'existe pas.|Erreur interne du serveur.|Service temporairement indisponible.|Veuillez réessayer plus tard.|Accès refusé.|Veuillez activer JavaScript dans votre navigateur.|Votre navigateur n'est pas pris en charge.|Votre session a expiré.|Trop de requêtes.|Site en construction.|Texte d'exemple.|Ceci est un faux texte.
""",
    r.FURNITURE: """
Главная|Форум|Контакты|О проекте|О сайте|Карта сайта|Обратная связь|Поиск по сайту|Вход на сайт|Регистрация|Новости|Гостевая книга|Главная | Новости | Форум | Контакты|Архив | Документы | Поиск|Все права защищены.|© 2015 Редакция сайта|При использовании материалов ссылка обязательна.|Перепечатка только с разрешения редакции.|Разработка и поддержка сайта|Последнее обновление: 5 мая 2012|Счётчик посещений: 12345|Сегодня на сайте 15 гостей|Наверх|Назад|Далее|Версия для печати|Поделиться|Нашли ошибку? Выделите её и нажмите Ctrl+Enter.|Политика конфиденциальности
Home|About us|Contact|Site map|Search|Login|Register|News|Guestbook|Home | News | Links | Contact|All rights reserved.|© 2015 The Editors|Reproduction only with permission.|Design by Webstudio|Last updated: 5 May 2012|Visitors: 12345|Back to top|Next page|Print version|Share this page|Privacy policy|Terms of use
Startseite|Kontakt|Impressum|Datenschutz|Suche|Anmelden|Gästebuch|Neuigkeiten|Startseite | Archiv | Impressum | Kontakt|Alle Rechte vorbehalten.|© 2015 Die Redaktion|Nachdruck nur mit Genehmigung.|Webdesign und Pflege|Letzte Änderung: 5. Mai 2012|Besucher: 12345|Nach oben|Druckversion
""",
    r.CONTENT: """
На сервере полка ошибки не нашли, потому что сервера не было.|Журналист спросил, почему страница дневника вырвана.|В архиве не нашли ни одной страницы этого приказа.|Запрос в архив отправили трижды, и доступ к делу открыли.|Описание боя отсутствует в журнале полка.|Доступ к мосту был закрыт до утра.|Он пишет, что сайт музея не работал неделю, и прислал копию письма.|Ошибка писаря стоила полку двух дней.|Связь была временно недоступна из-за метели.|Телефонист крикнул, что соединение прервано, и повторил вызов.|Страница 404 дела подшита после карты.|Раздел о переправе автор переписал заново.|Текст приказа не сохранился.|Включите меня в список добровольцев, сказал старшина.|Попробуйте перейти реку ночью, советовал разведчик.|Текст песни вспомнили на третий день.|Слово «робот» тогда никто не знал.|В тетради осталось место для фотографии.|По сценарию учений рота наступала первой.|Сценарий фильма о переправе написал ветеран.|Рыба в реке кормила весь гарнизон.|Повторите вопрос, пожалуйста.|Файл с картами лежал в сейфе штаба.|Главная улица посёлка сгорела.|Пример этого боя разбирали в академии.|Страницы журнала намокли и слиплись.
The page of the diary is missing, and nobody has found it.|Access to the bridge was denied to civilians.|The clerk's error cost the regiment two days.|The service of the ferry was suspended in winter.|He requested the file from the archive and waited a year.|The server at the officers' mess remembered the evening well.|The museum site was closed for a week, he said.|The road was under construction that summer.|The session of the court lasted until midnight.|Company 404 lost its way in the fog.|They found a sample of the order in the chest.|The text of the letter was later published.|He tried again later, and the crossing succeeded.|The printed form said insert name here.
Die Seite des Tagebuchs fehlt, und niemand hat sie gefunden.|Der Zugriff auf die Akte wurde erst später erlaubt.|Der Fehler des Schreibers kostete zwei Tage.|Der Dienst an der Brücke war hart.|Die Sitzung des Stabes dauerte bis Mitternacht.|Die Straße war noch im Bau.|Er versuchte es später noch einmal und kam über den Fluss.|Im Formular blieb das Feld leer.|Die 404. Kompanie fand den Weg nicht.|Der Text des Befehls ist nicht erhalten.
""",
}
# The common filler text after Cicero.
CICERO = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua ut enim ad minim veniam quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt in culpa qui officia deserunt mollit anim id est laborum sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque laudantium totam rem aperiam eaque ipsa quae ab illo inventore veritatis et quasi architecto beatae vitae dicta sunt explicabo nemo enim ipsam voluptatem quia voluptas aspernatur aut odit aut fugit sed quia consequuntur magni dolores eos qui ratione sequi nesciunt neque porro quisquam est qui dolorem ipsum quia dolor adipisci velit numquam eius modi tempora incidunt magnam aliquam quaerat vestibulum pellentesque habitant morbi tristique senectus netus malesuada fames turpis egestas praesent mauris fusce cursus rhoncus sem venenatis nunc phasellus ultrices".split()


def _any(patterns: list[str]) -> re.Pattern[str]:
    return re.compile("|".join(f"(?:{p})" for p in patterns), re.I)


_FILLER, _IS_FURNITURE, _IS_MESSAGE = re.compile(rf"^(?:(?:{_LATIN})[\s,.;:!?]*){{3,}}$", re.I), _any(_FURNITURE), _any(_MESSAGE)
_IS_DOMAIN, _IS_CUE, _TELLS = re.compile(_DOMAIN, re.I), re.compile(_CUE, re.I), re.compile(r"пишет|said|стоил|отправили|ни в одном", re.I)


def teach(x: str) -> int | None:
    if _FILLER.search(x):
        return r.MESSAGE
    if _IS_FURNITURE.search(x):
        return r.FURNITURE
    domain = _IS_DOMAIN.search(x)
    if _IS_MESSAGE.search(x) and (not domain or len(x) < 90 and not _TELLS.search(x)):
        return r.MESSAGE
    return r.CONTENT if domain or not _IS_CUE.search(x) else None


def examples(folder: str) -> list[tuple[str, int, float]]:
    rng = np.random.default_rng(5)
    out = [(s.strip(), k, 3.0) for k, text in EXAMPLES.items() for line in text.strip().split("\n") for s in line.split("|") if s.strip()]
    out += [(" | ".join(s.split("|")), r.FURNITURE, 1.0) for s in EXAMPLES[r.FURNITURE].strip().split("\n")]
    out += [(s.upper(), k, 1.0) for s, k, _ in out if k == r.MESSAGE]
    for _ in range(600):
        n = int(rng.integers(3, 18))
        at = int(rng.integers(0, len(CICERO) - n))
        words = CICERO[at : at + n] if rng.random() < 0.5 else list(rng.choice(CICERO, n))
        out.append((" ".join(words).capitalize() + ".", r.MESSAGE, 1.0))
    texts = pq.read_table(f"{folder}/documents.parquet", columns=["text"]).column(0).to_pylist()
    seen: dict[str, tuple[str, int]] = {}
    for i in rng.permutation(len(texts))[:SAMPLE]:
        for x in r.statements(texts[i] or ""):
            k = teach(x)
            if k is not None and not (k != r.MESSAGE and r.placeholder(x)):
                seen.setdefault(re.sub(r"\d+", "0", x), (x, k))
    rest = list(seen.values())
    few = [x for x in rest if x[1] != r.CONTENT]
    many = [x for x in rest if x[1] == r.CONTENT]
    many = [many[i] for i in rng.permutation(len(many))[:STATEMENTS]]
    return out + [(x, k, 1.0) for x, k in few + many]


def features(x: str) -> dict[int, float]:
    words = r._WORD.findall(x.casefold())
    root = len(words) ** 0.5 or 1.0
    out: dict[int, float] = {}
    inner = [f for w in words for f in r.Terms.word_features(w)] + [f for a, b in zip(words, words[1:]) for f in r.Terms.pair_features(a, b)]
    for k, v in inner:
        out[k] = out.get(k, 0.0) + v / root
    for k, v in r.Terms.shape_features(x, words):
        out[k] = out.get(k, 0.0) + v
    return out


def fit(data: list[tuple[dict[int, float], int, float, str]], held: set[int]) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(3)
    weights, bias = np.zeros((r.BUCKETS, 3)), np.zeros(3)
    square = np.full((r.BUCKETS, 3), 1e-3)
    balance = np.bincount([k for _, k, _, _ in data])
    for _ in range(EPOCHS):
        for i in rng.permutation(len(data)):
            if int(i) in held:
                continue
            f, k, w, _ = data[i]
            at, x = np.fromiter(f, np.int64, len(f)), np.fromiter(f.values(), np.float64, len(f))
            z = x @ weights[at] + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[k] -= 1
            # rare kinds weigh more; adaptive steps; a pull to nought keeps features of few statements small
            p *= w * min(4.0, (balance[r.CONTENT] / balance[k]) ** 0.5)
            g = np.outer(x, p) + 2e-4 * weights[at]
            square[at] += g * g
            weights[at] -= 0.12 * g / np.sqrt(square[at])
            bias -= 0.002 * p
    weights[np.abs(weights).max(1) < 0.02] = 0
    return weights, bias


def main(folder: str) -> None:
    data = [(features(x), k, w, x) for x, k, w in examples(folder)]
    held = {int(i) for i in np.random.default_rng(3).permutation(len(data))[: len(data) // 10]}
    print("statements", len(data), "by kind", np.bincount([k for _, k, _, _ in data]))
    weights, bias = fit(data, held)
    miss = 0
    for i in sorted(held):
        f, k, _, x = data[i]
        z = sum(weights[b] * v for b, v in f.items()) + bias
        if int(z.argmax()) != k:
            miss += 1
            print("missed", k, np.round(z, 1), x[:90])
    print("held out:", len(held), "statements,", miss, "judged otherwise")
    weights, bias = fit(data, set())
    at = np.flatnonzero(np.abs(weights).max(1))
    model = {"bias": [round(float(b), 3) for b in bias], "at": at.tolist(), "w": [[round(float(v), 2) for v in weights[b]] for b in at]}
    Path(__file__).with_name("models").joinpath("residue.json").write_text(json.dumps(model, separators=(",", ":")))


if __name__ == "__main__":
    main(sys.argv[1])
