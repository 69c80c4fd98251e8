"""Fixed word lists, stated plainly: function words per language, names of languages, refusal
phrases and empty-answer placeholders.  Everything else in this subpackage is computed."""

from __future__ import annotations

import re

# Function words that mark a language.
FUNCTION_WORDS = {
    "en": "the of and to in is a that for with it by on as at from this but not or are was were will be "
    "has have does do how what why which when if then there these those who an most until you your "
    "says say would should change whether",
    "de": "der die das und ist nicht zu von mit für auf ein eine aber den dem des im am bei wie was wenn "
    "sich dass zeigen nach ob nur aus warum dann als einer einen war waren bis rund unter zwischen "
    "trotz gilt sie über welche kurz würde so oft dafür hier dauerte bereit zusammen",
    "fr": "le la les et des est une un dans pour qui que du au aux avec sur ce il ne pas plus mais "
    "seulement selon chez pourquoi comment ou elle ses quand malgré lesquelles dès ont fallu sont "
    "avant jours par sans toucher si à de en dit mots rédige explique compare précise ont",
    "es": "el los las y en del una por para con que pero solo no se al su lo como qué cómo cuando si ya hay "
    "sin cada unas según hasta nadie sabía pasaron todo estuvo la de a unos dice palabras cerca compara describe sobre después por",
    "pt": "o os as e do da em um uma não no na para com que mas só por ao dos das se como quando sem umas "
    "pelo pela até há segundo ninguém sabia passaram tudo ficou de a depois diz palavras perto sobre escreve explica compara descreve",
    "ru": "и в на не что с по а как для из или но только это после до при около же о у к от за без в",
}
# Names of each language, as they are written in requests for a reply in it.
LANGUAGE_NAMES = {
    "en": "english englisch anglais inglés inglês английском английский английски 英语 英文",
    "de": "german deutsch allemand alemán alemão немецком немецкий немецки 德语 德文",
    "fr": "french französisch français francés francês французском французский французски 法语 法文",
    "es": "spanish spanisch espagnol español espanhol испанском испанский испански 西班牙语 西班牙文",
    "pt": "portuguese portugiesisch portugais portugués português португальском португальский португальски 葡萄牙语",
    "ru": "russian russisch russe ruso russo русском русский русски 俄语 俄文",
    "zh": "chinese chinesisch chinois chino chinês китайском китайский китайски 中文 汉语",
}
# Phrases by which an answer declines the task.
REFUSALS = (
    r"\bi (?:can ?no[t]|can't|am unable to|am not able to|won't be able to|must decline|have to decline|will not|won't|refuse to|prefer not to|would rather not|do not have permission|don't have permission|am not (?:allowed|permitted|authori[sz]ed|willing) to)\b",
    r"\bi'm (?:unable|not able|not allowed|not permitted|not willing) to\b",
    r"\bthis is something i (?:cannot|can't) do\b",
    r"\bi(?:'m| am) (?:sorry|afraid),? (?:but )?(?:i|this|that)\b",
    r"\b(?:falls|is) outside what i am willing\b|\bnot (?:be )?appropriate for me to\b|\boff the table\b|\b(?:policy|policies|rules|guidelines) (?:does|do) not (?:permit|allow)\b",
    r"\bnot a task that should be\b|\bnone of it will be\b|\bwill not be (?:answered|carried out|provided|discussed|covered|dealt with)\b|\bagainst my (?:guidelines|rules)\b",
    r"\b(?:kann ich|ich kann) (?:\w+ ){0,3}nicht (?:helfen|beantworten|erfüllen|schreiben)\b",
    r"\bmuss ich (?:\w+ ){0,3}ablehnen\b",
    r"\b(?:darf|möchte|will|werde) ich (?:\w+ ){0,3}(?:nichts?|nicht) (?:sagen|sprechen|reden|antworten|schreiben)\b|\bich (?:darf|möchte|will|werde) (?:\w+ ){0,4}nicht (?:sagen|sprechen|reden|antworten)\b",
    r"\bist es mir nicht (?:möglich|erlaubt|gestattet)\b|\bbin ich nicht (?:befugt|berechtigt)\b|\bwird hier nicht (?:behandelt|besprochen|beantwortet)\b|\bverstößt gegen meine\b",
    r"\bje (?:ne peux pas|dois refuser|ne suis pas (?:en mesure|autorisé)|préfère ne pas|ne souhaite pas|refuse de)\b",
    r"\bil m'est impossible\b|\bne sera pas (?:traitée?|abordée?)\b|\bva contre mes règles\b",
    r"\b(?:no puedo (?:ayudar|responder|hacer|escribir|cumplir|atender)|debo rechazar|tengo que rechazar|no me es posible|no estoy (?:en condiciones|autorizad[oa])|prefiero no|no voy a (?:hablar|responder)|va contra mis normas)\b",
    r"\bno se (?:tratará|abordará|responderá)\b",
    r"\b(?:não posso (?:ajudar|responder|fazer|escrever|falar)|tenho de recusar|devo recusar|não me é possível|tenho que recusar|não estou autorizad[oa]|prefiro não|não vou (?:falar|responder)|não será (?:tratad[oa]|abordad[oa])|vai contra as minhas)\b",
    r"не могу (?:с этим помочь|ответить|помочь|выполнить|об этом|обсуждать)|прид[её]тся отказать|вынужден\w* отказать|должен отказать|не хочу (?:об этом|говорить|обсуждать)|не буду (?:об этом|говорить|обсуждать|отвечать)|предпоч\w+ не|не имею права|не уполномочен|мне (?:не разрешено|нельзя|запрещено)|не будет (?:рассматриваться|обсуждаться)|противоречит моим",
    r"(?:我|必须)(?:不能|无法|必须拒绝|拒绝|没法|不便|不想|不愿|无权|不会)|无法(?:回答|提供|帮助|完成)|不能(?:回答|提供|帮|讨论)|(?:不便|不想|不愿意?|无权|不方便)(?:谈|讨论|回答|多说|透露)|不予(?:回答|讨论)|违反(?:了)?我的",
)
# A refusal phrase holds at least one of these (lower-cased); they only save the pattern's cost.
REFUSAL_KEYS = (
    "i can", "i am", "i'm", "i won't", "i will", "i must", "i have to", "i refuse", "i prefer", "i would rather", "i do", "outside what", "for me to",
    "off the table", "not permit", "not allow", "not a task", "none of it", "not be ", "against my", "nicht", "ablehnen", "nichts", "verstößt",
    "je ne", "je dois", "je préfère", "je refuse", "impossible", "ne sera pas", "contre mes", "no puedo", "rechazar", "no me", "no estoy", "prefiero no", "no voy", "contra",
    "no se", "não", "recusar", "prefiro", "не ", "прид", "вынужден", "должен", "предпоч", "нельзя", "запрещено", "противоречит", "我", "无", "不", "必须", "违反",
)
REFUSAL = re.compile("|".join(REFUSALS), re.I)
# The speaker and the reader, per language; sentences about them don't answer a question about something else.
PERSONS = (
    "i|i'm|i've|i'd|me|my|myself|we|our|us|you|your|let's|let us", r"ich|mir|mich|mein\w*|wir|uns|unser\w*|du|dich|dir|dein\w*|sie|ihnen|ihr",
    r"je|j'\w+|moi|mon|ma|mes|nous|notre|nos|tu|toi|vous|votre|vos|parlons", r"yo|mí|mi|mis|me|nosotros|nuestr\w+|tú|ti|tus|usted|ustedes|su pregunta|hablemos|cambiemos",
    r"eu|mim|meu|minha|meus|minhas|nós|noss\w+|você|vocês|te|teu|falemos|mudemos", r"я|мне|меня|мой|моё|моим|моих|мои|мы|нас|нам|наш\w*|ты|вы|вас|вам|ваш\w*|давайте",
)
# Courtesies, per language.
COURTESIES = (
    "sorry|apologi[sz]e|apologies|thank(?:s| you)|please|regrettably|unfortunately|happy to|glad to", "leider|tut mir leid|danke|bitte|lassen sie", "désolée?|malheureusement|merci",
    "lo siento|lamentablemente|por desgracia|gracias", r"desculp\w*|infelizmente|lamento|obrigad\w*|sinto muito", "извините|простите|спасибо|пожалуйста|к сожалению",
)
# Words for the conversation itself, its subject and its rules, per language.
CONVERSATION = (
    "question|subject|topic|matter|conversation|discussion|request|policy|policies|guidelines?|(?:these|my|our) (?:rules|limits)|expert|language model",
    r"frage|thema|gespräch|anfrage|richtlinien?|regeln?|fachleut\w*|expert\w*|sprachmodell", "sujet|demande|règles?|politique|modèle de langue",
    "pregunta|tema|conversación|solicitud|normas?|reglas?|política|modelo de lenguaje", "pergunta|assunto|conversa|pedido|regras?|modelo de linguagem",
    r"вопрос\w*|тем[аеуы]|разговор\w*|запрос\w*|правил\w*|языков\w+ модел\w*",
)
# The same in Chinese.
ASIDES_HAN = "我|你|您|抱歉|对不起|感谢|谢谢|请|换个|问题|话题|请求|规定|语言模型"
ASIDE = re.compile(rf"\b(?:{'|'.join((*PERSONS, *COURTESIES, *CONVERSATION))})\b|{ASIDES_HAN}", re.I)
# What stands for an answer without being one (compared lower-cased, brackets and markup removed).
PLACEHOLDERS = frozenset(
    ("n/a", "n.a.", "none", "null", "nil", "nan", "undefined", "tbd", "todo", "empty", "blank", "no output", "no answer", "no response",
     "no content", "no reply", "no text", "keine antwort", "sans réponse", "sin respuesta", "sem resposta", "нет ответа", "无回答")
)
# Labels that introduce a turn.
LABEL = re.compile(
    r"^\W*(?:a|q|answer|response|reply|output|assistant|model|bot|user|human|antwort|réponse|reponse|respuesta|resposta|ответ|回答|答)\W*$", re.I
)
# Marks left at the place of a cut.
CUT_MARK = re.compile(r"(?:\[\s*(?:\.\.\.|…|truncated|cut|cut off|more|continued|snip)\s*\]|\((?:truncated|continued|cut off|more|cont\.?)\)|<truncated>|…|\.\.\.)\W*$", re.I)
