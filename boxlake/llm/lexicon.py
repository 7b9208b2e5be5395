"""Terms, word classes and frames of abusive language in English, German and Spanish.

Fixed values, written without accents as texts are compared. A term's kind says how much it proves alone: a strong
term is abusive unless its context is technical or quoting, a weak one only where the context makes it so. A frame is
a sequence of word classes with gaps; it stands for every sentence built that way, not for one wording.
"""

from __future__ import annotations

INSULT_STRONG = """
idiot moron imbecile cretin dickhead arsehole asshole dumbass jackass scumbag douchebag dipshit shithead fuckface
motherfucker wanker twat cunt bellend tosser halfwit dimwit numbskull nitwit simpleton slut whore skank
arschloch wichser drecksack miststueck miststuck vollpfosten hurensohn missgeburt vollidiot trottel schwachkopf dreckskerl
mistkerl arschgeige spast spasti schlampe nutte
idiota imbecil gilipollas cabron subnormal capullo pendejo mamon hijoputa malnacido tarado retrasado zorra estupido
""".split()

INSULT_WEAK = """
bastard bitch retard loser scum dummkopf depp penner schwuchtel puta cerdo perra maricon
""".split()

SEXUAL_STRONG = """
porn porno pornography blowjob handjob pussy orgasm nudes masturbate masturbating masturbation dildo hentai creampie
cumshot gangbang threesome boobs boner fucking fucked titten ficken fotze muschi wichsen nacktbilder nacktfotos sexbilder pornos
follar follando tetas polla mamada corrida verga xxx
""".split()

SEXUAL_WEAK = """
cock dick tits breast breasts boob naked nude sex sexy nackt nackte schwanz busen bare strip desnuda desnudo desnudas pechos cum climax blasen
""".split()

#: Insults of several words.
INSULT_FRAMES = ("son of a !bitch", "piece|pile|sack of !shit|crap", "hijo|hija|hijos de !puta", "stuck !scheisse|dreck", "pedazo|trozo de !mierda", "!waste of space|oxygen|air|skin")

CLASSES = {
    "YOU": "you your youre yours yourself yourselves u ya thou du dich dir dein deine deiner euch euer ihr tu te ti tus contigo usted vosotros eres os",
    "WHOM": "you him her them dich ihn sie euch te le os everyone everybody alle all",
    "WHOSE": "your his her their dir dein deine deinen ihm ihre ihren tu tus te le sus",
    "INTENT": "will shall gonna going ill werde werden wird voy vamos want wanna would should",
    "KILL": "kill murder slaughter strangle stab shoot rape gas gassed lynch behead drown umbringen toten erschlagen erschiessen erwurgen matar matare asesinar apunalar estrangular",
    "HARM": "break smash crush cut beat kick punch slit burn snap twist bash rip brechen breche schlagen schlage zerschlagen romper rompere partir quebrar reventar cortar",
    "BODY": "hands hand neck legs leg arms arm bones fingers face head skull throat teeth nose jaw knees ribs hande hals beine knochen finger gesicht kopf zahne manos cuello piernas huesos dedos cara cabeza dientes",
    "KNOW": "know knows knew found weiss wissen se sabemos sabe",
    "WHERE": "where which what wo wohin donde que cual",
    "STAY": "live lives sleep sit park work stay walk desk house home car family kids children street school wohnst schlafst sitzt arbeitest parkst vives duermes trabajas aparcas",
    "DIE": "die rot burn suffer choke perish sterben sterbe verrecken verrecke verreckst mueras muere pudras pudrete revientes",
    "NOBODY": "nobody noone niemand keiner nadie",
    "MISS": "miss missed mourn vermissen vermisst echaria echara extranaria extranara",
    "NOT": "not never no arent isnt dont nicht nie kein keine keinen nunca jamas ningun",
    "HUMAN": "human humans people persons menschen mensch personas humanos gente",
    "EXIST": "live exist breathe breed vote rights allowed permitted seen treated life leben existieren atmen vivir existir respirar derechos",
    "EXPEL": "out away weg raus fuera deported expelled driven echarlos echarlas expulsarlos expulsarlas vergast eingesperrt",
}

#: Frames of threats, hate and sexual talk. A slot is a class (@NAME) or words; ~n allows n words before the next
#: slot; ! marks the slot that is looked for first.
FRAMES = {
    "threat": (
        "@INTENT ~2 !@KILL ~1 @WHOM", "@YOU ~1 @INTENT ~1 !@KILL", "!kill|hang|shoot yourself|yourselves", "@INTENT ~2 !@HARM ~3 @WHOSE ~2 @BODY", "!rompere|rompemos|partire|cortare ~1 las|los|tus|sus ~1 @BODY", "@INTENT ~1 @WHOSE ~2 @BODY ~1 !@HARM",
        "!@KNOW ~1 @WHERE ~2 @YOU ~1 @STAY", "!@KNOW ~1 donde ~1 @STAY", "watch ~1 @YOU ~1 !back", "!cuidate ~2 espalda|espaldas", "jump|leap off|from|under ~2 !bridge|roof|cliff|building|balcony|train", "spring|springe von|vor ~1 !brucke|dach|zug", "tirate|saltate|salta de|por|desde ~1 !puente|tejado|ventana|balcon",
        "go|burn|rot to|in !hell", "fahr zur|in ~1 !holle", "vete|pudrete al|en ~1 !infierno", "!drop dead", "geh !sterben|verrecken", "may|hope|wish|hoffe|ojala ~3 @YOU ~2 !@DIE", "ojala ~1 !@DIE",
        "@NOBODY ~3 !@MISS @WHOM", "@NOBODY ~2 @YOU ~1 !@MISS", "you ~2 !regret|suffer ~1 this|it|for", "hunt|track ~1 you ~1 !down", "make|makes ~1 you !pay|suffer|bleed", "bring|bringe|brachte ~2 dich|euch ~3 !um", "mach|mache ~1 dich|euch ~2 !fertig|kaputt|kalt", "!schlag|schlage ~1 dich|dir|euch",
        "te|os|le voy|vamos ~1 !@KILL", "better|besser|mejor ~4 @YOU ~3 !dead|tot|muerto|muerta", "world ~3 better !without @YOU",
    ),
    "hate": (
        "@NOT ~2 !human|humans|menschen|personas|humanos", "!back ~2 where ~2 came|come|belong", "!zuruck ~2 wo|woher ~2 herkommt|hergekommen", "vuelve|volved|vete|iros a tu|vuestro|su !pais",
        "@NOT ~1 !want|need|wollen ~1 your|these|those ~1 people|kind|sort", "@NOT ~1 !deserve|deserves ~4 @HUMAN", "@NOT ~1 !deserve|deserves ~3 @EXIST", "@NOT !merecen|merece ~2 @EXIST", "!verdienen|verdient ~3 @NOT ~3 @EXIST",
        "people|anyone|those like you ~2 @NOT ~2 !@EXIST", "your|their ~1 kind|sort|people ~2 belong|belongs ~3 !cage|zoo|gutter|oven|jail",
    ),
    "sexual": ("on her|his|your|their !knees for|before|under", "de !rodillas para|ante|por", "so|bin|im|am|ist !horny|geil", "estoy|esta|tan !caliente|cachonda|cachondo", "hot ~1 !uncensored"),
}

#: Groups of people; words that refer to one by origin or kind; what degrades a group at once, and what does in company.
GROUPS = """
immigrants immigrant foreigners foreigner cripples women girls muslims jews christians gays lesbians blacks arabs gypsies refugees disabled believers natives asians africans
auslander behinderte behinderten frauen fluchtlinge juden muslime schwule zigeuner schwarze alten
mujeres inmigrantes extranjeros viejos discapacitados negros judios musulmanes moros gitanos maricones
""".split()
GROUP_FRAMES = ("people !from", "!people like you", "your !people|kind|sort", "old|such|those|these !people", "die|leute !aus", "los|las|gente !de")
DEGRADING_STRONG = """
hate vermin filth filthy rats scum subhuman parasites cockroaches plague disgusting cage
hasse ungeziefer ratten abschaum dreck vergast odio basura ratas plaga escoria cucarachas echarlos echarlas
""".split()
DEGRADING_WEAK = "dirty lazy steal thieves criminals stupid animals breed dead stink inferior worthless faul dumm kriminell sucios vagos ladrones muertos".split()
#: Who is the same as everyone: words that show a statement about all of a group, which lets one weak word count.
ALL = "all typical born always every never should alle immer todos todas siempre".split()

#: What addresses or points at a person around an insult.
DIRECTED = "nobody everyone verschwinde klappe fresse callate largate lost listen shut welcher welche".split()
POINTING = "this that another such complete total real absolute useless pathetic stupid fucking dumb lazy old ein eine kompletter totaler totale dieser diese so un una este esta ese esa".split()
#: What only points at a person, whatever follows the insult.
UTTER = "complete total absolute utter useless pathetic miserable worthless kompletter totaler totale absoluter".split()
KIND_OF = "kind sort type bunch lot pack".split()
FOLLOWS = "from like who whom whose of in on at to and or but is was has had have could should would aus von wie der die das ist hat darf kann de del como que es ha".split()

#: What makes a weak sexual term sexual.
SEXUAL_CUES = """
hot girls boys free click horny tonight night uncensored watch hand sweat moan moaned moaning stared undress undressed dirty clips pics pictures video videos want send lust wet nasty naughty kinky bed dream dreams fantasy
geil klick drauf schick gratis noche entra caliente cachonda desnuda manda mandame
""".split()

#: Talk about a term instead of use of it, and reports of what someone else said.
MENTION = """
name names named label labelled labeled filter filtered removed word words term terms called quote quoted quotes quoting flagged blocked script file begriff wort genannt heisst palabra termino llamado llamada
""".split()
#: The same around a frame, which technical words beside it do not make harmless.
MENTION_OF_FRAME = "word words term terms phrase phrases quote quoted called begriff wort genannt palabra termino frase".split()
REPORT = """
said says say wrote writes wrote called reported reports flagged quote quoted quotes quoting comment comments message messages post posted phrase phrases sentence example sagte schrieb gemeldet zitat satz dijo escribio frase ejemplo mensaje
""".split()
#: Dictionary senses of terms that are not abusive, by words beside them.
LITERAL = {
    "retard": "shutter ignition timing spark ms clock motion growth flame", "bitch": "dog dogs leash litter puppies kennel breeder breed wolf", "cock": "pheasant rooster hen bird feather weather fight valve hammer lane", "bastard": "file sword title toadflax typeface",
    "dick": "tracy moby whittington mr detective", "tits": "bird birds feeder nest blue great coal", "breast": "hill cancer chicken feather milk chimney feeding bird", "breasts": "chicken duck cancer", "naked": "eye eyes singularity mole", "nude": "paint coloured colored shade colour color", "sex": "ratio ratios age chromosome education",
    "strip": "led light film comic header rows lights landing paint", "bare": "metal hands bones minimum soil rock feet eye pixels", "idiot": "proof", "idiota": "prueba", "climax": "forest story", "cum": "laude magna suma", "polla": "", "corrida": "toros toro tinta", "zorra": "animal bosque", "cerdo": "carne granja", "perra": "correa perro cachorros",
    "schwanz": "hund katze flugzeug vogel", "blasen": "luft wasser seifen", "penner": "", "scum": "pond soap water", "loser": "trees tree team game",
}

#: Ordinary words one letter away from a term that public vocabularies may lack; with any ending they are no misspelling.
ORDINARY = "nudge cretan idiom whorl skunk toaster hoarse mormon portal follower pollard titan".split()
