"""Seed texts for the residue models, written out with alternatives: ``{a|b}`` stands for a and b, ``{|a}`` for a or nothing."""

from __future__ import annotations

import itertools
import random
import re
from collections.abc import Callable

SCRIPT = [
    "{Please|You need to|You must} {enable|allow|activate|turn on} {JavaScript|scripts|scripting} {to continue|to view this page|to see the comments|to load the map|to use the booking form|to use this site}.",
    "This site requires {JavaScript|scripts|scripting}; {enable|allow|activate|turn on} it {to continue|to view this page|to see the comments|to load the map|to use the booking form}.",
    "{JavaScript|scripting|scripts} is disabled in your browser. {Enable|Allow|Activate|Turn on} it {to continue|to view this page|to see the comments|to load the map|to use the booking form}.",
    "This page does not work without JavaScript. Your browser does not support scripts.",
    "Bitte {aktivieren|erlauben} Sie {JavaScript|die Ausführung von Skripten}, um {fortzufahren|diese Seite anzuzeigen|die Karte zu laden|die Kommentare zu sehen|das Formular zu nutzen}.",
    "Um {fortzufahren|diese Seite anzuzeigen|die Karte zu laden|die Kommentare zu sehen}, muss {JavaScript|die Ausführung von Skripten} eingeschaltet sein.",
    "{JavaScript|die Ausführung von Skripten} ist in Ihrem Browser deaktiviert. {Aktivieren|Erlauben} Sie es, um {fortzufahren|diese Seite anzuzeigen|die Karte zu laden}.",
    "{Veuillez|Vous devez} {activer|autoriser} {JavaScript|les scripts} pour {continuer|afficher cette page|charger la carte|voir les commentaires|utiliser le formulaire}.",
    "{JavaScript|les scripts} désactivé dans votre navigateur : il faut l'{activer|autoriser} pour {continuer|afficher cette page|charger la carte|voir les commentaires}.",
    "{Por favor,|Debe} {active|permita|habilite|activar|permitir|habilitar} {JavaScript|los scripts} para {continuar|ver esta página|cargar el mapa|ver los comentarios|usar el formulario}.",
    "Este sitio necesita {JavaScript|los scripts}: {active|permita} la opción para {continuar|ver esta página|cargar el mapa|ver los comentarios}.",
    "{Si prega di|È necessario|Occorre} {abilitare|attivare|consentire} {JavaScript|gli script} per {continuare|visualizzare questa pagina|vedere questa pagina|caricare la mappa|vedere i commenti}.",
    "Questo sito richiede {JavaScript|gli script}: {attivi|abiliti|consenta} l'opzione per {continuare|visualizzare questa pagina|caricare la mappa}. {JavaScript|Gli script} disattivato nel browser.",
    "Deze site werkt niet zonder {JavaScript|scripts}; {inschakelen|toestaan|aanzetten} is nodig om {door te gaan|deze pagina te bekijken|de kaart te laden|de reacties te zien}.",
    "{Schakel|Zet} {JavaScript|scripts} {in|aan} om {door te gaan|deze pagina te bekijken|de kaart te laden}. Sta scripts toe in uw browser. JavaScript is uitgeschakeld in uw browser.",
    "<noscript>{Please enable JavaScript|Bitte aktivieren Sie JavaScript|Veuillez activer JavaScript|Por favor, active JavaScript|Si prega di abilitare JavaScript|Deze site werkt niet zonder JavaScript}</noscript>",
]

SCRIPT += [
    "{Turn|Switch} {JavaScript|scripts|scripting} {on|back on} {in your settings|in your browser settings|in the browser|first|and reload the page|and refresh this page|and try again}.",
    "{JavaScript|Scripting|Script support} {must be|needs to be|has to be|should be} {enabled|turned on|activated|allowed} {in your browser|for this site|to use this page|before you continue}.",
    "{This|Our} {page|site|website|application|app|service|form} {needs|requires|relies on|depends on|works only with|only works with} {JavaScript|scripts|client-side scripts}.",
    "{We are sorry, but this|Sorry, this} {page|site|app} {does not work properly without|doesn't work without|cannot be shown without|can't run without} {JavaScript|scripts} {enabled|turned on}. Please enable it to continue.",
    "{It looks like|It seems that|We detected that} {JavaScript|scripting} is {disabled|turned off|switched off|blocked|not enabled|not available} {in|by} your browser.", "Your browser {has JavaScript disabled|blocks scripts|is blocking JavaScript|does not run JavaScript|has scripting turned off}. {Please change the settings|Allow it and reload the page|Enable it to proceed}.",
    "{No JavaScript|JavaScript required|JavaScript is off|JavaScript not detected|JavaScript is not enabled|Without JavaScript this page cannot work}", "Enable {JavaScript|scripts} {and cookies|} {to continue|to proceed|to view the content|to see this content|in your browser settings}.", "Activate JavaScript {in the browser options|to display the content|to watch this video|to log in}.",
    "{Bitte|Zum Fortfahren bitte} {JavaScript|Skripte} {einschalten|aktivieren|zulassen|erlauben} {und die Seite neu laden|in den Einstellungen Ihres Browsers|}.", "{Diese Seite|Diese Website|Diese Anwendung|Der Dienst} {benötigt|erfordert|braucht|funktioniert nur mit|läuft nicht ohne} {JavaScript|Skripte|aktiviertes JavaScript}.", "{JavaScript|Skripte} {muss|müssen} {aktiviert|eingeschaltet|erlaubt|zugelassen} {sein|werden}.", "{Ihr Browser|Der Browser} {unterstützt kein JavaScript|hat JavaScript deaktiviert|blockiert Skripte}. {Schalten Sie JavaScript ein|Lassen Sie Skripte zu}, um die Seite zu nutzen.",
    "{Cette page|Ce site|Cette application|Le service} {nécessite|requiert|exige|a besoin de|ne fonctionne pas sans} {JavaScript|scripts|que JavaScript soit activé}.", "{Merci d'|Il faut |Veuillez }{activer|autoriser|débloquer} {JavaScript|les scripts} {dans votre navigateur|et recharger la page|dans les paramètres|avant de continuer}.", "{JavaScript|Le script} {est désactivé|semble désactivé|doit être activé|n'est pas activé|est bloqué} {dans votre navigateur|pour utiliser ce site|}.", "Votre navigateur {bloque les scripts|n'exécute pas JavaScript|ne prend pas en charge JavaScript}.",
    "{Esta página|Este sitio|Esta aplicación|El servicio} {requiere|necesita|precisa|no funciona sin} {JavaScript|scripts|que JavaScript esté activado}.", "{Es necesario|Debe|Hay que|Tiene que} {activar|habilitar|permitir} {JavaScript|los scripts} {en su navegador|y recargar la página|en la configuración|antes de seguir}.", "{JavaScript|La ejecución de scripts} {está desactivado|está deshabilitada|debe estar activado|no está habilitado|está bloqueado} {en su navegador|para usar este sitio|}.", "Su navegador {bloquea los scripts|no admite JavaScript|no ejecuta JavaScript}. Active JavaScript {e inténtelo de nuevo|y vuelva a cargar}.",
    "{Questa pagina|Questo sito|Questa applicazione|Il servizio} {richiede|necessita di|ha bisogno di|non funziona senza} {JavaScript|script|JavaScript attivo}.", "{Bisogna|Occorre|Per favore|È necessario} {abilitare|attivare|consentire} {JavaScript|gli script} {nel browser|e ricaricare la pagina|nelle impostazioni|prima di continuare}.", "{JavaScript|L'esecuzione degli script} {è disattivato|è disabilitata|deve essere attivo|non è abilitato|è bloccato} {nel suo browser|nel tuo browser|per usare questo sito|}.",
    "{Deze pagina|Deze website|Deze toepassing|De dienst} {vereist|heeft|werkt alleen met|gebruikt|werkt niet zonder} {JavaScript|scripts|JavaScript nodig}.", "{Zet|Schakel|Sta} {JavaScript|scripts} {aan|in|toe} {in uw browser|en laad de pagina opnieuw|in de instellingen|voordat u verdergaat}.", "{JavaScript|Het uitvoeren van scripts} {is uitgeschakeld|staat uit|moet aan staan|moet ingeschakeld zijn|is geblokkeerd} {in uw browser|om deze site te gebruiken|}.",
    "{Пожалуйста, |Необходимо |}{включите|включить|разрешите|разрешить} JavaScript{| в браузере|, чтобы продолжить| для просмотра страницы}.", "{Для работы сайта требуется|Сайту необходим|Страница не работает без} {JavaScript|JavaScript в браузере}. В вашем браузере отключен JavaScript.", "{Por favor, |}{ative|habilite|permita} o JavaScript {para continuar|no seu navegador|para ver esta página}. O JavaScript está desativado no seu navegador.", "{Proszę włączyć|Włącz} {JavaScript|obsługę skryptów}{, aby kontynuować| w przeglądarce}. Ta strona wymaga JavaScript.",
    "请启用 JavaScript {以继续|后重试|查看此页面}。 您的浏览器已禁用 JavaScript。", "{JavaScript|スクリプト}を有効にしてください。 このページを表示するには JavaScript が必要です。", "JavaScript를 {사용|활성화}하도록 설정하십시오. 이 페이지를 보려면 JavaScript가 필요합니다.",
]

_ERRORS = [
    (
        "404",
        [
            "Not Found", "The page you requested does not exist", "Page not found", "This page could not be found", "Seite nicht gefunden",
            "Die angeforderte Seite existiert nicht", "Page introuvable", "La page demandée n'existe pas", "Página no encontrada",
            "La página solicitada no existe", "Pagina non trovata", "La pagina richiesta non esiste", "Pagina niet gevonden",
            "De gevraagde pagina bestaat niet"
        ]
    ),
    (
        "403",
        [
            "Forbidden", "Access denied", "You do not have permission to view this page", "Zugriff verweigert",
            "Sie dürfen diese Seite nicht ansehen", "Sie haben keine Berechtigung für diese Seite", "Accès interdit", "Accès refusé",
            "Vous n'avez pas le droit de voir cette page", "Acceso denegado", "Acceso prohibido", "No tiene permiso para ver esta página",
            "Accesso negato", "Accesso vietato", "Non ha il permesso di vedere questa pagina", "Toegang geweigerd",
            "U mag deze pagina niet bekijken"
        ]
    ),
    (
        "500",
        [
            "Internal Server Error", "Something went wrong on our side", "Interner Serverfehler",
            "Auf unserer Seite ist etwas schiefgelaufen", "Erreur interne du serveur", "Un problème est survenu",
            "Un problème est survenu de notre côté", "Error interno del servidor", "Algo ha fallado por nuestra parte",
            "Algo ha salido mal", "Algo ha ido mal por nuestra parte", "Algo salió mal", "Errore interno del server",
            "Qualcosa è andato storto", "Qualcosa è andato storto da parte nostra", "Interne serverfout", "Er ging iets mis aan onze kant",
            "Er is iets misgegaan", "Er is iets misgegaan aan onze kant"
        ]
    ),
    (
        "502",
        [
            "Bad Gateway", "Fehlerhaftes Gateway", "Passerelle incorrecte", "Mauvaise passerelle", "Réponse incorrecte de la passerelle",
            "Puerta de enlace incorrecta", "Gateway non valido", "Ongeldige gateway"
        ]
    ),
    (
        "503",
        [
            "Service unavailable", "The site is down for maintenance", "Dienst nicht verfügbar", "Wartungsarbeiten am Server",
            "Service indisponible", "Site en maintenance", "Le site est en maintenance", "Servicio no disponible",
            "El sitio está en mantenimiento", "Servizio non disponibile", "Sito in manutenzione", "Dienst niet beschikbaar",
            "De site is in onderhoud", "Onderhoud aan de server"
        ]
    ),
    (
        "504",
        [
            "Gateway Timeout", "The gateway timed out", "Zeitüberschreitung am Gateway", "Délai de la passerelle dépassé",
            "Délai d'attente dépassé", "Le délai d'attente de la passerelle est dépassé", "Tiempo de espera agotado",
            "Se agotó el tiempo de espera", "Tempo scaduto del gateway", "Timeout van de gateway"
        ]
    ),
    (
        "429",
        [
            "Too many requests, try again later", "Too many requests", "Zu viele Anfragen", "Zu viele Anfragen, später erneut versuchen",
            "Trop de requêtes", "Trop de demandes, réessayez plus tard", "Demasiadas solicitudes",
            "Demasiadas peticiones, inténtelo más tarde", "Troppe richieste", "Te veel verzoeken", "Te veel aanvragen, probeer het later"
        ]
    ),
]
_ERRORS += [
    (
        "400",
        [
            "Bad Request", "Invalid request", "The server could not understand the request", "Ungültige Anfrage", "Fehlerhafte Anfrage",
            "Requête incorrecte", "Mauvaise requête", "Solicitud incorrecta", "Petición no válida", "Richiesta non valida",
            "Ongeldig verzoek", "Ongeldige aanvraag"
        ]
    ),
    (
        "401",
        [
            "Unauthorized", "Authorization required", "Login required", "You must log in to see this page", "Nicht autorisiert",
            "Anmeldung erforderlich", "Non autorisé", "Connexion requise", "No autorizado", "Debe iniciar sesión", "Non autorizzato",
            "Accesso richiesto", "Niet geautoriseerd", "Aanmelden vereist"
        ]
    ),
    (
        "408",
        [
            "Request Timeout", "The request timed out", "Connection timed out", "Zeitüberschreitung der Anfrage", "Requête expirée",
            "La demande a expiré", "La solicitud ha caducado", "Richiesta scaduta", "Time-out van het verzoek"
        ]
    ),
    (
        "410",
        [
            "Gone", "This page has been removed", "The page has moved", "Diese Seite wurde entfernt", "Cette page a été supprimée",
            "Esta página se ha eliminado", "Questa pagina è stata rimossa", "Deze pagina is verwijderd"
        ]
    ),
    (
        "500",
        [
            "Server error", "Application error", "An error occurred", "An unexpected error has occurred", "Unexpected error",
            "An internal error occurred", "The server encountered an error", "Es ist ein Fehler aufgetreten", "Unerwarteter Fehler",
            "Ein unerwarteter Fehler ist aufgetreten", "Serverfehler", "Une erreur est survenue", "Une erreur inattendue s'est produite",
            "Erreur du serveur", "Se ha producido un error", "Ha ocurrido un error inesperado", "Error del servidor",
            "Si è verificato un errore", "Si è verificato un errore imprevisto", "Errore del server", "Er is een fout opgetreden",
            "Er is een onverwachte fout opgetreden", "Serverfout", "Внутренняя ошибка сервера", "Произошла ошибка",
            "Erro interno do servidor", "Ocorreu um erro", "Wystąpił błąd", "内部服务器错误", "サーバーエラーが発生しました"
        ]
    ),
    (
        "404",
        [
            "The requested URL was not found on this server", "We can't find that page", "We could not find the page you are looking for",
            "The page you are looking for does not exist", "File not found", "Nothing found here", "Die Seite wurde nicht gefunden",
            "Die gesuchte Seite gibt es nicht", "Datei nicht gefunden", "Cette page n'existe pas", "Nous ne trouvons pas cette page",
            "Fichier introuvable", "No hemos encontrado la página", "Esta página no existe", "Archivo no encontrado",
            "Questa pagina non esiste", "La pagina cercata non è stata trovata", "File non trovato", "Deze pagina bestaat niet",
            "We kunnen deze pagina niet vinden", "Bestand niet gevonden", "Страница не найдена", "Página não encontrada",
            "Nie znaleziono strony", "页面不存在", "ページが見つかりません", "페이지를 찾을 수 없습니다"
        ]
    ),
    (
        "403",
        [
            "You don't have permission to access this resource", "Permission denied", "Access to this page is restricted", "Kein Zugriff",
            "Zugriff auf diese Seite nicht erlaubt", "Vous n'êtes pas autorisé à accéder à cette page", "Accès non autorisé",
            "No está autorizado a ver esta página", "Permiso denegado", "Non è autorizzato a vedere questa pagina", "Permesso negato",
            "U heeft geen toegang tot deze pagina", "Geen toegang", "Доступ запрещен", "Acesso negado", "Odmowa dostępu", "拒绝访问"
        ]
    ),
    (
        "503",
        [
            "The server is temporarily unavailable", "Temporarily unavailable", "Under maintenance, please come back later",
            "We are currently performing maintenance", "The service is temporarily unavailable", "Vorübergehend nicht erreichbar",
            "Der Server ist zurzeit nicht verfügbar", "Wegen Wartung nicht erreichbar", "Temporairement indisponible",
            "Le serveur est momentanément indisponible", "Temporalmente no disponible", "El servidor no está disponible en este momento",
            "Temporaneamente non disponibile", "Il server non è al momento disponibile", "Tijdelijk niet beschikbaar",
            "De server is momenteel niet bereikbaar", "Сервис временно недоступен"
        ]
    ),
]
_STATUS = "{HTTP ERROR 000|HTTP/0.0 000 X|Error 000|Error code: 000|Status 000: X|Error: X|Fehlercode 000|Code erreur 000|Código de error 000|Codice di errore 000|Foutcode 000|Error 000: X|000 X|HTTP 000 - X|X (000)|X|X.|HTTP-Status 000 - X|Fehler 000: X|Erreur 000 : X|Errore 000: X|Fout 000: X|Error HTTP 000: X|Oops! X.|Hoppla! X.|Oups ! X.|¡Vaya! X.|Ops! X.|Oeps! X.}"
#: One template a message, short ones several times so that they weigh as much as long ones.
MESSAGES = [(_STATUS.replace("X", m).replace("000", code), 8 if len(m) < 12 else 1) for code, all_ in _ERRORS for m in all_]
ERROR = [
    "{Oops! |Sorry! |}{We could not load this page|Something went wrong}. Try refreshing it. Please try again later.", "{Your session has expired|Session expired}. Please log in again.", "This content is no longer available.", "Could not connect to the database server. Error establishing a database connection.",
    "{Hoppla! |}Die Seite konnte nicht geladen werden. Bitte neu laden. Bitte versuchen Sie es erneut.", "Ihre Sitzung ist abgelaufen. Bitte erneut anmelden.", "Dieser Inhalt ist nicht mehr verfügbar.", "Keine Verbindung zur Datenbank möglich.",
    "{Oups ! |}Impossible de charger cette page. Essayez de l'actualiser. Veuillez réessayer.", "Votre session a expiré. Veuillez vous reconnecter.", "Ce contenu n'est plus disponible.", "Connexion à la base de données impossible.",
    "{¡Vaya! |}No se ha podido cargar la página. Intente actualizarla. Pruebe a recargarla.", "Su sesión ha {caducado|expirado}. {Vuelva a iniciar sesión|Inicie sesión de nuevo}.", "Este contenido ya no está disponible.", "No se pudo conectar con la base de datos.",
    "{Ops! |}Impossibile caricare la pagina. Provi ad aggiornarla. Riprovare.", "La {sessione|sua sessione} è scaduta. {Acceda di nuovo|Effettui di nuovo l'accesso}.", "Questo contenuto non è più disponibile.", "Connessione al database non riuscita.",
    "{Oeps! |}De pagina kon niet worden geladen. Probeer te vernieuwen.", "Uw sessie is verlopen. {Log opnieuw in|Meld u opnieuw aan}.", "Deze inhoud is niet meer beschikbaar.", "{Kan geen verbinding maken|Geen verbinding} met de database{| mogelijk}.",
    "{An unexpected error has occurred|Something went wrong|An error occurred while processing your request}. {Our team has been notified|We are working on it|Please contact support|Contact the administrator|Please try again in a few minutes|Go back to the home page}.", "{Unable to|Failed to|Could not|Cannot} {load|display|fetch|retrieve|open} {the|this|your} {page|content|data|results|comments|document}. {Reload the page|Retry|Check your connection}.", "{This site can't be reached|The connection was reset|No internet connection|The server took too long to respond|The connection has timed out}.",
    "{Return to the home page|Back to the home page|Go back} or {try a search|contact the webmaster|use the menu}.", "The {link|page} you followed {may be broken|has expired|is no longer valid}, or the page may have been removed.", "{This|The} {video|article|page|document|item} is {unavailable|not available|no longer available} {in your country|at the moment|}.",
    "{Die Seite|Der Inhalt|Das Dokument} {kann nicht angezeigt werden|konnte nicht gefunden werden|ist nicht erreichbar|ist derzeit nicht verfügbar}. {Versuchen Sie es später erneut|Zurück zur Startseite}.", "{La page|Le contenu|Le document} {ne peut pas être affiché|est introuvable|n'a pas pu être chargé|n'est pas disponible}. {Réessayez plus tard|Retour à l'accueil}.", "{La página|El contenido|El documento} {no se puede mostrar|no se encuentra|no se ha podido cargar|no está disponible}. {Inténtelo de nuevo más tarde|Volver al inicio}.", "{La pagina|Il contenuto|Il documento} {non può essere visualizzata|non è stato trovato|non è disponibile}. {Riprova più tardi|Torna alla home}.", "{De pagina|De inhoud|Het document} {kan niet worden weergegeven|is niet gevonden|is niet beschikbaar}. {Probeer het later opnieuw|Terug naar de startpagina}.",
    "NameError: name is not defined", "{KeyError|ValueError|AttributeError|IndexError|RuntimeError|ImportError}: {object has no attribute|list index out of range|invalid literal for int|no module named app}", "Exception in thread main java.lang.{IllegalStateException|RuntimeException|OutOfMemoryError}: {Java heap space|could not start}", "{Fatal error|Parse error|Notice|Warning}: {syntax error, unexpected end of file|Uncaught Error|Undefined index|Allowed memory size of 000000 bytes exhausted} in /home/www/public_html/index.php on line 00", "{MySQL|PostgreSQL|Database|SQL} error: {server has gone away|too many connections|connection refused|syntax error at or near|could not connect to server}", "{nginx|Apache|Cloudflare} Ray ID: {error 000|host error}", "{Uncaught |}{ReferenceError|SyntaxError|TypeError}: {cannot read properties of undefined|unexpected token|x is not defined}", "panic: runtime error: {invalid memory address or nil pointer dereference|index out of range}", "{CAPTCHA|Verify you are human|Checking your browser before accessing}", "{404|500} page: {oops, nothing here|sorry, we lost this page}",
    "upstream connect error or disconnect before headers. reset reason: overflow", "SQLSTATE[HY000] [2002] Connection refused", "Traceback (most recent call last):", "Traceback (most recent call last): File \"/srv/app/views.py\", line 000, in render", "Fatal error: Call to a member function on null given in /var/www/html/page.php on line 000",
    "Fatal error: Uncaught TypeError: null given in /var/www/site/page.php on line 000", "java.lang.NullPointerException at app.site.Page.load(Page.java:000)", "[object Object] undefined is not a function at main.js:00", "Uncaught TypeError: undefined is not a function", "Unhandled exception. Segmentation fault (core dumped)", "Warning: Undefined variable in /var/www/html/index.php on line 00",
]

_LATIN = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua velit quoque anima finis grave umbra domus silvam nullum terram tandem quare lucem nomen ordo fluctu pictor ramos campus brevis pulsa stella vento serra mundo porta tenet".split()
#: The passages that filler texts are taken from.
_PASSAGES = [
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua ut enim ad minim veniam quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt in culpa qui officia deserunt mollit anim id est laborum",
    "sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque laudantium totam rem aperiam eaque ipsa quae ab illo inventore veritatis et quasi architecto beatae vitae dicta sunt explicabo nemo enim ipsam voluptatem quia voluptas sit aspernatur aut odit aut fugit sed quia consequuntur magni dolores eos qui ratione voluptatem sequi nesciunt neque porro quisquam est qui dolorem ipsum quia dolor sit amet consectetur adipisci velit",
    "at vero eos et accusamus et iusto odio dignissimos ducimus qui blanditiis praesentium voluptatum deleniti atque corrupti quos dolores et quas molestias excepturi sint occaecati cupiditate non provident similique sunt in culpa qui officia deserunt mollitia animi id est laborum et dolorum fuga et harum quidem rerum facilis est et expedita distinctio nam libero tempore",
    "vestibulum ante ipsum primis in faucibus orci luctus et ultrices posuere cubilia curae pellentesque habitant morbi tristique senectus et netus et malesuada fames ac turpis egestas proin sodales quam nec sollicitudin semper mauris ipsum egestas urna vel condimentum ligula nunc sed lorem aenean lacinia bibendum nulla maecenas faucibus mollis interdum cras justo odio dapibus ac facilisis in egestas eget quam nullam quis risus eget urna mollis ornare vel eu leo",
    "the quick brown fox jumps over the lazy dog", "franz jagt im komplett verwahrlosten taxi quer durch bayern", "portez ce vieux whisky au juge blond qui fume", "el veloz murcielago hindu comia feliz cardillo y kiwi", "pranzo d'acqua fa volti sghembi", "съешь же ещё этих мягких французских булок да выпей чаю",
]
_REPEATED = [
    "text", "test", "foo bar", "asdf", "qwerty", "xxxx", "xxx", "todo", "tbd", "abc", "bla", "blah", "lorem", "ipsum", "texte", "texto",
    "testo", "tekst", "prueba", "essai", "prova", "aaa", "123"
]
FILLER = [
    "This is {dummy|filler|placeholder|sample} {copy|text}. Replace it before publishing.", "Sample paragraph, to be replaced.", "{Your|Insert} text {goes |}here.", "{Headline|Title|Text|Content} goes here", "Coming soon: content.", "Insert your content here",
    "{Add|Insert|Enter|Type|Write|Put|Place} {your|the|a|some} {text|title|name|description|content|copy|caption|headline|image|bio|message} here.", "{Insert|Enter|Add} {description|title|name|image caption|product name|text|date}.", "{Click|Tap} here to {edit|add|change} {this|the|your} {text|title|content}.", "{Text|Content|Description|Copy|Image|Details} {to be added|to come|to follow|pending|coming soon|goes here}.", "{This|The following} {is|paragraph is|section is} {only|just|} {a|an} {example|placeholder|sample|dummy} {text|paragraph|page}.", "{Placeholder|Dummy|Sample|Example|Test} {text|content|title|paragraph|copy|page|post}.", "{To be completed|To be announced|To be determined|Under construction|Description missing|No description yet|Your name here|Your company name|Your slogan here}.", "{Replace|Delete|Edit} this {text|paragraph|sentence} with your own.",
    "{Text|Titel|Beschreibung|Name|Bild} {hier|} {einfügen|eingeben|ergänzen|folgt|einsetzen}.", "{Platzhaltertext|Beispieltext|Mustertext|Blindtext|Fülltext|Testtext}, {bitte austauschen|nur zur Ansicht|wird noch ersetzt}.", "{Hier|An dieser Stelle} {steht|kommt|erscheint} {Ihr|der|bald} {Text|Inhalt|Titel}.", "{Insérez|Ajoutez|Saisissez|Placez} {votre|le|un} {texte|titre|nom|contenu} ici.", "{Texte|Paragraphe|Titre|Contenu} {d'exemple|provisoire|fictif|factice|de remplissage|à remplacer|à compléter}.", "{Inserte|Añada|Escriba|Ponga} {su|el|un} {texto|título|nombre|contenido} aquí.", "{Texto|Párrafo|Título|Contenido} {de ejemplo|provisional|ficticio|de prueba|por completar|de relleno}.", "{Inserisci|Aggiungi|Scrivi|Inserire} {qui il|il tuo|un} {testo|titolo|nome|contenuto}{| qui}.", "{Testo|Paragrafo|Titolo|Contenuto} {di esempio|provvisorio|fittizio|di prova|da completare|segnaposto}.", "{Voeg|Typ|Plaats|Zet} hier {uw|de|een} {tekst|titel|naam|inhoud}{| in}.", "{Voorbeeldtekst|Plaatshoudertekst|Proeftekst|Vultekst|Opvultekst}, {nog te vervangen|alleen ter illustratie|graag aanpassen}.", "{Здесь будет|Вставьте сюда|Замените этот} {текст|ваш текст|заголовок}.", "{Insira|Adicione} seu texto aqui.", "{Wpisz|Wstaw} {tekst|tytuł} tutaj.", "{在此输入|请输入}{文字|内容|标题}。", "ここに{テキスト|タイトル}を入力してください。",
    "Das ist ein Blindtext, bitte ersetzen.", "Hier steht später Ihr Text.", "{Inhalt|Text} folgt in Kürze.", "Musterabsatz ohne Bedeutung.", "{Überschrift|Titel} folgt",
    "Titre à venir", "Titre à venir.", "Titre ici", "Ceci est un faux texte à remplacer.", "Votre {texte|titre} ici.", "{Contenu|Titre|Texte} à venir.", "Paragraphe d'exemple sans contenu.",
    "Este es un texto {de relleno|ficticio|falso}, {por reemplazar|sustituir|reemplácelo|a sustituir}.", "Su {texto|título} {va |}aquí.", "{Contenido|Título} próximamente.", "Párrafo de muestra sin contenido.",
    "Questo è un testo {segnaposto|fittizio|finto}, {da sostituire|sostituire}.", "{Il suo|Il tuo|Inserire il} testo {va |}qui.", "{Contenuto|Titolo} in arrivo.", "Paragrafo di esempio senza contenuto.",
    "Dit is een opvultekst, graag vervangen.", "{Hier komt|Plaats hier} uw tekst.", "{Inhoud|Titel|Tekst} volgt {binnenkort|nog}.", "Voorbeeldalinea zonder {inhoud|betekenis}.",
]

#: What stands around the name of an unfilled slot, and the names' shapes. A bare number in square brackets is a reference, no slot.
_AROUND = [
    ("{", "}"), ("{{", "}}"), ("[", "]"), ("<", ">"), ("%", "%"), ("${", "}"), ("<%= ", " %>"), ("__", "__"), ("##", "##"), ("[[", "]]"), ("@{", "}"), ("%(", ")a"), ("{{ ", " }}"), ("[[ ", " ]]"),
    ("{{{", "}}}"), ("<<", ">>"), ("%%", "%%"), ("*|", "|*"), ("#{", "}"), ("{$", "}"), ("$", "$"), ("$(", ")"), ("@@", "@@"), ("{%", "%}"), ("{% ", " %}"), ("<%", "%>"), ("<% ", " %>"), ("[%", "%]"), ("||", "||"), ("::", "::"), ("{{#", "}}"), ("[:", "]"), ("<!-- ", " -->"), ("~~", "~~"),
]
_USUAL = ("{", "[", "<", "%", "${", "__", "##", "@{")
_NAMES = ["a", "a_a", "a_a_a", "a a", "a a a", "a a a a", "a.a", "a-a", "a a_a", "0"]
_SLOTS = [
    f"{o}{n}{c}" for o, c in _AROUND for n in _NAMES if not (
        n == "0" and o in ("[", "[[", "[[ ", "%", "$", "<", "##", "__", "$(", "::", "~~")
    ) and not (" " in n and o in ("%", "$", "__", "##", "::", "||", "~~", "%%", "@@", "%("))
]
#: In the shape of a text, where a stands for a word and 0 for a number.
_AMONG = ("X", "a X", "a X,", "a X!", "a X.", "X a", "a X a", "a X, a", "a: X", "a. X", "a, X", "0 X a", "a X 0")

NATURAL = [
    "The teacher wrote the word javascript on the board, and nobody asked why.", "She read four scripts by heart before the play began.", "He made an error in the sum and the shop paid it back.", "The page was not found in the folder, so the clerk looked again.",
    "The guard denied access to the cars because the bridge was closed.", "The service was available to everyone, even at night.", "Bus 404 waited in front of house 503.", "The lines {4, 7, 12} share a platform (see map [3]), and a ticket costs $5.", "At 100 % load the engine was quiet.",
    "Die Wache verweigerte den Autos die Durchfahrt.", "Der Zähler machte einen Fehler und die Firma zahlte ihn zurück.", "Le garde a refusé l'accès aux voitures parce que le pont était fermé.", "Le compteur a fait une erreur, et la société l'a remboursée.", "El guardia negó el acceso a los coches porque el puente estaba cerrado.",
    "La guardia ha negato l'accesso alle auto perché il ponte era chiuso.", "De wacht weigerde de auto's de toegang omdat de brug dicht was.", "In the morning the baker opened the door and swept the step.", "We walked along the river until it was dark, and then we went home.", "It rained all week, but the harvest was better than last year.",
    "Am Morgen öffnete der Bäcker die Tür und fegte die Stufe.", "Le matin, le boulanger ouvre la porte et balaie la marche.", "Por la mañana el panadero abre la puerta y barre el escalón.", "La mattina il fornaio apre la porta e spazza il gradino.", "In de ochtend opent de bakker de deur en veegt de stoep.",
]


def expanded(templates: list[str], most: int = 60, seed: int = 3) -> list[str]:
    """All texts of the templates, or ``most`` seeded ones of a template that has more."""
    rng, out = random.Random(seed), []
    for t in templates:
        parts = re.split(r"\{([^{}]*\|[^{}]*)\}", t)
        choices = [p.split("|") if i % 2 else [p] for i, p in enumerate(parts)]
        every = list(itertools.product(*choices))
        out += ["".join(c) for c in (every if len(every) <= most else rng.sample(every, most))]
    return out


def filler(keep: Callable[[int], bool], seed: int = 5) -> list[str]:
    """The filler templates, shuffled pseudo-Latin, passages and repeated words."""
    rng = random.Random(seed)
    latin = [" ".join(rng.choices(_LATIN, k=rng.randint(5, 14))) for _ in range(150)]
    latin += ["lorem ipsum dolor sit amet, " + t for t in latin[:30]] + ["lorem ipsum, " + t for t in latin[30:60]] + [
        " ".join(rng.choices(_LATIN[:20], k=10)) + "." for _ in range(100)
    ]
    for passage in (p.split() for i, p in enumerate(_PASSAGES) if keep(i)):
        latin += [" ".join(passage)] + [" ".join(passage[i : i + 12]) for i in range(0, max(len(passage) - 6, 1), 6)]
    templates = [t for i, t in enumerate(FILLER) if keep(i)]
    return expanded(templates) * 3 + latin + [" ".join([w] * rng.randint(3, 9)) for w in _REPEATED for _ in range(4)]


def by_kind(keep: Callable[[int], bool] = lambda i: True) -> dict[str, list[str]]:
    """The seed texts of each kind of residue, of those templates, messages and slots whose place ``keep`` holds for."""
    error = [t for i, t in enumerate(ERROR) if keep(i)] + [t for i, (t, n) in enumerate(MESSAGES) if keep(i) for _ in range(n)]
    return {
        "filler": filler(keep), "error": expanded(error), "script": expanded([t for i, t in enumerate(SCRIPT) if keep(i)]),
        "placeholder": [f.replace("X", s) for i, s in enumerate(_SLOTS) if keep(i) for f in _AMONG for _ in range(3 if s.startswith(_USUAL) else 1)],
    }
