"""Word lists about names of people and organisations; all are parameters' defaults and may be extended."""

# Common given names.
GIVEN = frozenset(
    """abigail adam agnes alan albert alexander alice amy andrew angela anita anna anthony arthur barbara benjamin
    brian carl carol caroline catherine charles charlotte christine christopher claire clara claudia dana daniel
    david deborah dennis diana donald dorothy edward elena elizabeth emily emma eric erik ernest eva felix frances
    francis frank frederick gabriel george gerald gregory hannah harold harry heather helen henrik henry hugo ian
    ingrid irene isabel jack jacob james jane janet jason jennifer jessica joan johan john jonathan jon joseph
    joshua judith julia karen karl katherine keith kenji kenneth kevin laura lawrence leonard linda lisa louise
    lucia lucy margaret maria marie mark marta martha martin mary matthew michael miguel monica nancy nathaniel
    nicholas nicole nora olaf oliver oscar pamela patricia patrick paul peter philip priya rachel ralph raymond
    rebecca richard robert roger ronald rose ruth samuel sandra sara sarah sean sofia sophie stefan stephen steven
    stuart susan teresa theodore thomas timothy ursula vera victor victoria vincent virginia walter wendy william
    yusuf zofia""".split()
)

# Short and pet forms of given names; some stand for several.
SHORT_FORMS = {
    short: tuple(full.split(","))
    for short, full in (
        x.split("=")
        for x in """abby=abigail abbie=abigail gail=abigail alex=alexander al=alexander,albert,alan sasha=alexander sandy=alexander
    xander=alexander tony=anthony ant=anthony ben=benjamin benny=benjamin benji=benjamin chris=christopher
    kit=christopher,katherine topher=christopher dan=daniel danny=daniel deb=deborah debbie=deborah debby=deborah
    ed=edward,edwin,edmund eddie=edward ned=edward ted=theodore teddy=theodore theo=theodore liz=elizabeth
    beth=elizabeth betty=elizabeth eliza=elizabeth lizzie=elizabeth lisbeth=elizabeth fred=frederick freddie=frederick
    rick=richard rich=richard dick=richard ricky=richard greg=gregory jen=jennifer jenny=jennifer jenn=jennifer
    joanie=joan jonny=jon kate=katherine kathy=katherine katie=katherine kath=katherine kay=katherine
    ken=kenneth,kenji lucy=lucia peggy=margaret maggie=margaret meg=margaret marge=margaret madge=margaret
    marty=martin nate=nathaniel nat=nathaniel,natalie nathan=nathaniel pat=patricia patty=patricia trish=patricia
    tricia=patricia bob=robert rob=robert bobby=robert robbie=robert bert=robert,albert,herbert sam=samuel,samantha
    sammy=samuel sue=susan susie=susan suzy=susan tom=thomas tommy=thomas thom=thomas uschi=ursula ulla=ursula
    vicky=victoria vicki=victoria tori=victoria vic=victoria walt=walter wally=walter bill=william will=william
    billy=william willy=william liam=william joe=joseph,yusuf zosia=zofia henk=henrik rik=henrik hank=henrik
    inga=ingrid hughie=hugo martie=marta mike=michael mick=michael jim=james jimmy=james jack=john johnny=john
    dave=david steve=stephen andy=andrew matt=matthew nick=nicholas tim=timothy jeff=jeffrey larry=lawrence
    charlie=charles harry=henry,harold joey=joseph josh=joshua ron=ronald ray=raymond phil=philip pete=peter
    vince=vincent cathy=catherine sally=sarah molly=mary polly=mary nell=helen ellie=eleanor becky=rebecca
    mandy=amanda cindy=cynthia terry=teresa tess=teresa""".split()
    )
}
#: Forms that stand for one name, and those that may stand for several.
NICKNAMES = {short: full[0] for short, full in SHORT_FORMS.items() if len(full) == 1}
AMBIGUOUS = {short: full for short, full in SHORT_FORMS.items() if len(full) > 1}

# Words that mark an organisation, and their short forms.
ORG_WORDS = frozenset("institute computing laboratories laboratory research foundation company systems limited partners software incorporated corporation university college group associates association society consulting technologies networks services privacy industries press agency office department committee council".split())
ORG_SHORT = {"co": "company", "cos": "company", "ltd": "limited", "inc": "incorporated", "corp": "corporation", "fdn": "foundation", "found": "foundation", "lab": "laboratories", "labs": "laboratories", "res": "research", "inst": "institute", "univ": "university", "sys": "systems", "assoc": "associates", "comp": "computing", "soft": "software", "sw": "software", "ptnrs": "partners", "priv": "privacy", "cptg": "computing"}

# Titles before a name.
TITLES = frozenset("dr prof professor mr mrs ms miss sir herr frau".split())
