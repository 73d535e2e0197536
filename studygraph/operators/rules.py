"""Rule tables of the extractors. Patterns are matched over text in lower case."""

from __future__ import annotations

Rule = tuple[str, str, float]

# Pattern, anchor type, confidence, in order of precedence.
ANCHORS: tuple[Rule, ...] = (
    # general
    (r"first\s+(?:dose|administration)\s+of\s+(?:study\s+)?(?:drug|medication|treatment|investigational\s+product)", "FirstDose", 0.95),
    (r"day\s+1\s+(?:of\s+)?(?:cycle\s+1|treatment|dosing)", "FirstDose", 0.90),
    (r"initiation\s+of\s+(?:study\s+)?treatment", "FirstDose", 0.85),
    (r"start\s+of\s+(?:study\s+)?(?:treatment|therapy|intervention)", "FirstDose", 0.85),
    (r"treatment\s+(?:start|initiation|commencement)", "FirstDose", 0.80),
    (r"day\s+(?:of\s+)?randomization", "Randomization", 0.90),
    (r"randomization\s+(?:visit|day|date)", "Randomization", 0.90),
    (r"days?\s+(?:from|after|since)\s+randomization", "Randomization", 0.85),
    (r"post[\-\s]?randomization", "Randomization", 0.80),
    (r"day\s+1\s*[=:]\s*(?:baseline|first\s+visit)", "Day1", 0.85),
    (r"baseline\s+(?:visit|day|assessment)", "Baseline", 0.80),
    (r"week\s+0\s+(?:of\s+)?treatment", "Baseline", 0.80),
    (r"pre[\-\s]?treatment\s+(?:baseline|assessment)", "Baseline", 0.80),
    (r"screening\s+(?:visit|period|day)", "Screening", 0.70),
    (r"informed\s+consent", "InformedConsent", 0.75),
    (r"enrollment\s+(?:visit|day)", "Enrollment", 0.75),
    # oncology
    (r"cycle\s+1[,\s]+day\s+1", "CycleStart", 0.85),
    (r"c1d1", "CycleStart", 0.80),
    (r"first\s+(?:infusion|injection)\s+(?:of\s+)?(?:study\s+)?(?:drug|treatment)", "FirstDose", 0.90),
    (r"start\s+of\s+(?:chemotherapy|immunotherapy|targeted\s+therapy)", "FirstDose", 0.85),
    (r"day\s+1\s+of\s+(?:induction|consolidation|maintenance)", "FirstDose", 0.85),
    (r"first\s+(?:cycle|course)\s+of\s+(?:treatment|therapy)", "CycleStart", 0.85),
    # vaccines
    (r"(?:first|prime)\s+(?:vaccination|immunization|dose)", "FirstDose", 0.90),
    (r"day\s+(?:of\s+)?(?:prime|first)\s+vaccination", "FirstDose", 0.90),
    (r"vaccination\s+day\s+(?:1|one)", "FirstDose", 0.85),
    (r"post[\-\s]?vaccination\s+day\s+\d+", "FirstDose", 0.80),
    (r"challenge\s+(?:day|date)", "Custom", 0.80),
    # cardiology
    (r"(?:index|qualifying)\s+(?:event|mi|stroke|hospitalization)", "Custom", 0.85),
    (r"days?\s+(?:from|after|since)\s+(?:index|qualifying)\s+event", "Custom", 0.85),
    (r"post[\-\s]?(?:mi|stroke|pci|cabg)", "Custom", 0.80),
    (r"hospital\s+discharge", "Custom", 0.75),
    (r"days?\s+(?:from|after)\s+discharge", "Custom", 0.80),
    # neurology
    (r"(?:first|initial)\s+(?:seizure|episode|attack)", "Custom", 0.80),
    (r"symptom\s+onset", "Custom", 0.80),
    (r"days?\s+(?:from|after|since)\s+(?:diagnosis|onset)", "Custom", 0.80),
    (r"titration\s+(?:start|initiation|period)", "FirstDose", 0.75),
    # surgery and devices
    (r"(?:day\s+of\s+)?(?:surgery|procedure|implantation|transplant)", "Custom", 0.85),
    (r"post[\-\s]?(?:operative|surgical|procedure)", "Custom", 0.80),
    (r"days?\s+(?:from|after|since)\s+(?:surgery|procedure|implant)", "Custom", 0.85),
    (r"device\s+(?:implantation|activation)", "Custom", 0.80),
    (r"transplant(?:ation)?\s+(?:day|date)", "Custom", 0.85),
    # rare diseases
    (r"first\s+(?:infusion|injection)\s+of\s+(?:enzyme|gene\s+therapy|replacement)", "FirstDose", 0.90),
    (r"start\s+of\s+(?:enzyme|gene)\s+(?:replacement\s+)?therapy", "FirstDose", 0.85),
    (r"loading\s+dose", "FirstDose", 0.80),
    # diabetes
    (r"(?:first|initial)\s+(?:injection|dose)\s+of\s+(?:insulin|glp[\-\s]?1|sglt)", "FirstDose", 0.90),
    (r"start\s+of\s+(?:insulin|basal|bolus)\s+(?:therapy|treatment)", "FirstDose", 0.85),
    (r"clamp\s+(?:procedure|study)\s+(?:day|start)", "Custom", 0.80),
    (r"glucose\s+(?:challenge|tolerance\s+test)", "Custom", 0.75),
    # infections
    (r"first\s+dose\s+of\s+(?:antibiotic|antiviral|antifungal)", "FirstDose", 0.90),
    (r"start\s+of\s+(?:antimicrobial|antiretroviral)\s+therapy", "FirstDose", 0.85),
    (r"(?:infection|symptom)\s+(?:onset|diagnosis)", "Custom", 0.80),
    # eyes and skin
    (r"(?:first|initial)\s+(?:intravitreal\s+)?injection", "FirstDose", 0.90),
    (r"day\s+of\s+(?:injection|treatment)\s+(?:in\s+)?(?:study|treated)\s+eye", "FirstDose", 0.85),
    (r"first\s+(?:application|dose)\s+of\s+(?:topical|study)\s+(?:drug|treatment)", "FirstDose", 0.85),
    (r"start\s+of\s+(?:topical|phototherapy)\s+treatment", "FirstDose", 0.80),
)

# What an anchor of each type means; a Custom one means what the text says.
ANCHOR_DEFINITIONS = {
    "FirstDose": "First administration of investigational product",
    "Randomization": "Date of subject randomization",
    "Day1": "Study Day 1 (baseline)",
    "Baseline": "Baseline visit/assessment",
    "Screening": "Screening visit",
    "Enrollment": "Subject enrollment date",
    "InformedConsent": "Informed consent obtained",
    "CycleStart": "Day 1 of Cycle 1",
}

# Pattern, kind of repetition, confidence.
REPETITIONS: tuple[Rule, ...] = (
    (r"daily\s+(?:urine|blood|sample|collection|measurement|assessment)", "Daily", 0.90),
    (r"once\s+daily", "Daily", 0.85),
    (r"every\s+day", "Daily", 0.85),
    (r"each\s+day\s+(?:of|during)", "Daily", 0.80),
    (r"(?:collect|measure|assess)\s+daily", "Daily", 0.85),
    (r"(?:qd|q\.d\.|od)", "Daily", 0.80),
    (r"daily\s+(?:glucose|blood\s+sugar|bg)\s+(?:monitoring|measurement)", "Daily", 0.90),
    (r"(?:smbg|self[\-\s]?monitoring)\s+daily", "Daily", 0.85),
    (r"daily\s+(?:diary|log)\s+(?:entry|entries)", "Daily", 0.80),
    (r"daily\s+weight", "Daily", 0.85),
    (r"daily\s+(?:blood\s+pressure|bp)\s+(?:monitoring|measurement)", "Daily", 0.90),
    (r"daily\s+(?:heart\s+rate|hr|pulse)", "Daily", 0.85),
    (r"daily\s+(?:ecg|ekg|holter)", "Daily", 0.85),
    (r"daily\s+(?:oral|po)\s+(?:dosing|administration)", "Daily", 0.85),
    (r"daily\s+(?:symptom|toxicity)\s+(?:assessment|diary)", "Daily", 0.80),
    (r"daily\s+(?:seizure|headache|migraine)\s+(?:diary|log)", "Daily", 0.85),
    (r"daily\s+(?:pain|symptom)\s+(?:score|rating)", "Daily", 0.80),
    (r"daily\s+(?:enzyme|substrate|biomarker)\s+(?:level|measurement)", "Daily", 0.85),
    (r"daily\s+(?:temperature|fever)\s+(?:monitoring|check)", "Daily", 0.85),
    (r"daily\s+(?:viral|bacterial)\s+(?:load|count)", "Daily", 0.85),
    (r"every\s+(\d+)\s*(?:min(?:ute)?s?)", "Interval", 0.90),
    (r"at\s+(?:time\s+)?(\d+(?:,\s*\d+)+)\s*(?:min(?:ute)?s?)", "Interval", 0.90),
    (r"(\d+)\s*(?:min(?:ute)?s?)\s+intervals?", "Interval", 0.85),
    (r"q(\d+)min", "Interval", 0.85),
    (r"every\s+(\d+)\s*(?:hour|hr)s?", "Interval", 0.90),
    (r"(\d+)\s*(?:hour|hr)s?\s+intervals?", "Interval", 0.85),
    (r"q(\d+)h", "Interval", 0.85),
    (r"(?:bid|b\.i\.d\.)", "Interval", 0.80),
    (r"(?:tid|t\.i\.d\.)", "Interval", 0.80),
    (r"(?:qid|q\.i\.d\.)", "Interval", 0.80),
    (r"(?:pk|pharmacokinetic)\s+(?:samples?|sampling)\s+(?:at|:)\s*([\d,\s\.]+)", "Interval", 0.95),
    (r"(?:pd|pharmacodynamic)\s+(?:samples?|sampling)\s+(?:at|:)\s*([\d,\s\.]+)", "Interval", 0.95),
    (r"(?:0|pre[\-\s]?dose)[,\s]+(\d+(?:[,\s]+\d+)*)\s*(?:min|hour|hr)", "Interval", 0.90),
    (r"time\s+(?:0|zero)[,\s]+(\d+(?:[,\s]+\d+)*)", "Interval", 0.85),
    (r"glucose\s+(?:every|q)\s*(\d+)\s*(?:min|hour|hr)", "Interval", 0.90),
    (r"(?:cgm|continuous\s+glucose)", "Interval", 0.85),
    (r"glucose\s+at\s+(\d+(?:,\s*\d+)+)\s*(?:min|hour)", "Interval", 0.90),
    (r"(?:ecg|ekg|bp)\s+(?:every|q)\s*(\d+)\s*(?:min|hour|hr)", "Interval", 0.90),
    (r"(?:holter|ambulatory)\s+(?:monitoring|ecg)", "Interval", 0.85),
    (r"post[\-\s]?(?:vaccination|injection)\s+(?:at|every)\s*(\d+)\s*(?:min|hour)", "Interval", 0.90),
    (r"observation\s+(?:period|every)\s*(\d+)\s*(?:min|hour)", "Interval", 0.85),
    (r"(?:during|post)\s+infusion\s+(?:at|every)\s*(\d+)\s*(?:min|hour)", "Interval", 0.90),
    (r"infusion[\-\s]?related\s+(?:monitoring|assessment)", "Interval", 0.80),
    (r"(\d+)[\s-]*day\s+cycle", "Cycle", 0.90),
    (r"cycle\s+(?:length|duration)\s*(?:is|of|:)?\s*(\d+)\s*days?", "Cycle", 0.90),
    (r"repeat(?:ed)?\s+every\s+(\d+)\s*(?:days?|weeks?)", "Cycle", 0.85),
    (r"(\d+)[\s-]*week\s+cycle", "Cycle", 0.90),
    (r"(?:21|28|35|42)[\s-]*day\s+(?:treatment\s+)?cycle", "Cycle", 0.90),
    (r"(?:3|4|6)[\s-]*week\s+(?:treatment\s+)?cycle", "Cycle", 0.90),
    (r"cycle\s+\d+\s+day\s+\d+", "Cycle", 0.85),
    (r"c\d+d\d+", "Cycle", 0.80),
    (r"until\s+(?:disease\s+)?progression", "Cycle", 0.80),
    (r"until\s+(?:unacceptable\s+)?toxicity", "Cycle", 0.80),
    (r"until\s+(?:death|withdrawal|discontinuation)", "Cycle", 0.75),
    (r"(?:maximum|up\s+to)\s+(\d+)\s+cycles?", "Cycle", 0.85),
    (r"maintenance\s+(?:phase|therapy)\s+(?:every|q)\s*(\d+)\s*(?:days?|weeks?)", "Cycle", 0.85),
    (r"(?:continue|continued)\s+(?:until|for)\s+(\d+)\s*(?:cycles?|weeks?|months?)", "Cycle", 0.80),
    (r"(?:prime|boost(?:er)?)\s+(?:at|on)\s+(?:day|week)\s+(\d+)", "Cycle", 0.85),
    (r"(?:second|third|booster)\s+(?:dose|vaccination)\s+(?:at|on)", "Cycle", 0.85),
    (r"vaccination\s+(?:at|on)\s+(?:day|week)s?\s+(\d+(?:,\s*\d+)*)", "Cycle", 0.90),
    (r"(?:dialysis|hemodialysis)\s+(?:sessions?|days?)", "Cycle", 0.85),
    (r"(?:3|three)\s+times?\s+(?:per|a)\s+week", "Cycle", 0.85),
    (r"day(?:s)?\s*([-–−]?\d+)\s*(?:to|through|[-–−])\s*(?:day\s*)?([-–−]?\d+)", "Continuous", 0.90),
    (r"from\s+day\s*([-–−]?\d+)\s+to\s+day\s*([-–−]?\d+)", "Continuous", 0.90),
    (r"during\s+(?:the\s+)?(\d+)[\s-]*day\s+(?:period|window)", "Continuous", 0.85),
    (r"throughout\s+(?:the\s+)?(?:treatment|study)\s+period", "Continuous", 0.75),
    (r"week(?:s)?\s*(\d+)\s*(?:to|through|[-–])\s*(?:week\s*)?(\d+)", "Continuous", 0.90),
    (r"from\s+week\s*(\d+)\s+to\s+week\s*(\d+)", "Continuous", 0.90),
    (r"(?:screening|washout|run[\-\s]?in)\s+(?:period|window|phase)", "Continuous", 0.85),
    (r"(?:treatment|active|dosing)\s+(?:period|window|phase)", "Continuous", 0.85),
    (r"(?:follow[\-\s]?up|observation|safety)\s+(?:period|window|phase)", "Continuous", 0.85),
    (r"(?:pre|post)[\-\s]?(?:dose|treatment|surgery|procedure)\s+(?:period|window)", "Continuous", 0.85),
    (r"(\d+)\s+(?:days?|hours?)\s+(?:before|after|pre|post)", "Continuous", 0.80),
    (r"(?:in[\-\s]?patient|hospitalization|confinement)\s+(?:period|days?)", "Continuous", 0.85),
    (r"(?:days?\s+)?[-–]?\s*(\d+)\s+to\s+(?:day\s+)?(\d+)\s+(?:in[\-\s]?patient|hospitalized)", "Continuous", 0.85),
    (r"(?:balance|metabolic)\s+(?:period|collection|study)", "Continuous", 0.90),
    (r"(?:24|48|72)[\-\s]?(?:hour|hr)\s+(?:urine|stool|collection)", "Continuous", 0.90),
    (r"washout\s+(?:period|phase)\s+(?:of\s+)?(\d+)\s*(?:days?|weeks?)", "Continuous", 0.90),
    (r"(?:minimum|at\s+least)\s+(\d+)\s*(?:days?|weeks?)\s+washout", "Continuous", 0.85),
)

# Pattern, execution type, confidence.
EXECUTION_TYPES: tuple[Rule, ...] = (
    (r"day(?:s)?\s*[-–]?\d+\s*(?:to|through|[-–])\s*(?:day\s*)?[-–]?\d+", "Window", 0.90),
    (r"from\s+day\s*[-–]?\d+\s+to\s+day", "Window", 0.90),
    (r"week(?:s)?\s*\d+\s*(?:to|through|[-–])\s*(?:week\s*)?\d+", "Window", 0.90),
    (r"during\s+(?:the\s+)?(?:\d+[\s-]*day|entire|full)\s+(?:period|window|phase)", "Window", 0.85),
    (r"throughout\s+(?:the\s+)?(?:treatment|study|dosing|observation)\s+period", "Window", 0.85),
    (r"continuous(?:ly)?\s+(?:monitor|collect|measure|record)", "Window", 0.85),
    (r"over\s+(?:a\s+)?(?:\d+[\s-]*(?:day|hour|week))\s+period", "Window", 0.85),
    (r"daily\s+(?:collection|measurement|monitoring|assessment|diary)", "Window", 0.80),
    (r"once\s+daily\s+(?:for|during|throughout)", "Window", 0.80),
    (r"every\s+day\s+(?:of|during|for)", "Window", 0.80),
    (r"every\s+\d+\s*(?:min(?:ute)?s?|hours?)\s+(?:for|during|over)", "Window", 0.85),
    (r"at\s+\d+(?:,\s*\d+)+\s*(?:min(?:ute)?s?|hours?)", "Window", 0.85),
    (r"(?:glucose|cgm|blood\s+sugar)\s+(?:monitoring|measurement)\s+(?:for|during|over)", "Window", 0.90),
    (r"clamp\s+(?:procedure|study)", "Window", 0.85),
    (r"(?:meal|glucose)\s+tolerance\s+test", "Window", 0.85),
    (r"(?:24|48|72)[\s-]*(?:hour|hr)\s+(?:urine|stool|collection|monitoring)", "Window", 0.90),
    (r"(?:holter|ambulatory|continuous)\s+(?:ecg|ekg|monitoring)", "Window", 0.90),
    (r"(?:24|48)[\s-]*(?:hour|hr)\s+(?:bp|blood\s+pressure|ecg|ekg)", "Window", 0.90),
    (r"telemetry\s+monitoring", "Window", 0.85),
    (r"(?:balance|metabolic)\s+(?:period|study|collection)", "Window", 0.90),
    (r"(?:copper|iron|zinc|substrate)\s+(?:balance|excretion)", "Window", 0.90),
    (r"(?:in[\-\s]?patient|hospitalization|confinement)\s+(?:period|stay)", "Window", 0.85),
    (r"during\s+(?:hospitalization|admission|stay)", "Window", 0.85),
    (r"during\s+(?:the\s+)?infusion", "Window", 0.85),
    (r"(?:infusion|injection)\s+(?:period|window)", "Window", 0.85),
    (r"(?:pk|pd|pharmacokinetic|pharmacodynamic)\s+(?:sampling|profile|window)", "Window", 0.90),
    (r"serial\s+(?:blood|plasma|serum)\s+(?:samples?|sampling)", "Window", 0.85),
    (r"if\s+(?:the\s+)?(?:patient|subject|value|level|result)", "Episode", 0.90),
    (r"when\s+(?:the\s+)?(?:value|level|result)\s*(?:is|exceeds?|falls?|drops?)", "Episode", 0.90),
    (r"once\s+(?:the\s+)?(?:target|threshold|level)\s+(?:is\s+)?(?:reached|achieved|met)", "Episode", 0.90),
    (r"in\s+(?:the\s+)?(?:event|case)\s+(?:of|that)", "Episode", 0.85),
    (r"(?:then|followed\s+by|subsequently)\s+(?:administer|give|perform|collect)", "Episode", 0.85),
    (r"after\s+(?:the\s+)?(?:first|initial|previous)\s+(?:dose|measurement|assessment)", "Episode", 0.85),
    (r"prior\s+to\s+(?:the\s+)?(?:next|subsequent|following)", "Episode", 0.80),
    (r"before\s+(?:and\s+after|proceeding)", "Episode", 0.80),
    (r"until\s+(?:the\s+)?(?:value|level|glucose|response)\s*(?:is|reaches?|exceeds?)", "Episode", 0.90),
    (r"until\s+(?:stable|normal|baseline|target|resolved)", "Episode", 0.85),
    (r"continue\s+(?:until|unless|while)", "Episode", 0.85),
    (r"(?:if|when)\s+(?:pg|glucose|lab|value|result)\s*[<>≤≥=]\s*\d+", "Episode", 0.90),
    (r"threshold\s+(?:of\s+)?\d+", "Episode", 0.80),
    (r"(?:above|below|exceeds?|falls?\s+below)\s+\d+", "Episode", 0.85),
    (r"rescue\s+(?:medication|therapy|treatment|intervention)", "Episode", 0.85),
    (r"(?:administer|give)\s+(?:rescue|emergency|additional)", "Episode", 0.85),
    (r"(?:breakthrough|escape)\s+(?:medication|therapy|treatment)", "Episode", 0.85),
    (r"(?:if|when)\s+(?:glucose|blood\s+sugar|bg)\s*[<≤]\s*\d+", "Episode", 0.95),
    (r"hypoglycemi(?:a|c)\s+(?:event|episode|rescue)", "Episode", 0.90),
    (r"(?:glucagon|dextrose|glucose)\s+(?:rescue|administration)", "Episode", 0.90),
    (r"(?:dose|treatment)\s+(?:modification|reduction|interruption|delay)", "Episode", 0.85),
    (r"(?:if|when)\s+(?:toxicity|adverse\s+event|ae)\s+(?:occurs?|is\s+observed)", "Episode", 0.90),
    (r"(?:grade\s+)?[≥>]\s*[234]\s+(?:toxicity|adverse\s+event)", "Episode", 0.90),
    (r"(?:hold|withhold|discontinue)\s+(?:treatment|dosing)\s+(?:if|until)", "Episode", 0.85),
    (r"(?:if|when)\s+(?:bp|blood\s+pressure|hr|heart\s+rate)\s*[<>]\s*\d+", "Episode", 0.90),
    (r"(?:chest\s+pain|angina|arrhythmia)\s+(?:occurs?|is\s+reported)", "Episode", 0.85),
    (r"(?:if|when)\s+(?:seizure|attack|episode)\s+occurs?", "Episode", 0.90),
    (r"(?:rescue|abortive)\s+(?:medication|treatment)", "Episode", 0.85),
    (r"(?:if|when)\s+(?:reaction|adverse\s+event)\s+occurs?", "Episode", 0.85),
    (r"(?:anaphylaxis|anaphylactic)\s+(?:protocol|management)", "Episode", 0.90),
    (r"(?:infusion|injection)[\s-]*(?:related\s+)?reaction", "Episode", 0.85),
    (r"(?:slow|stop|pause)\s+(?:infusion|injection)\s+(?:if|when)", "Episode", 0.90),
    (r"(?:at\s+)?(?:screening|baseline|randomization)\s+(?:only|visit)", "Single", 0.85),
    (r"(?:one|single)\s+time\s+(?:only|at)", "Single", 0.80),
    (r"(?:performed|collected|assessed)\s+once", "Single", 0.80),
    (r"(?:one[\s-]*time|single)\s+(?:assessment|measurement|collection)", "Single", 0.85),
    (r"(?:at\s+)?(?:enrollment|entry|day\s+1)\s+only", "Single", 0.85),
    (r"(?:at\s+)?end[\s-]*of[\s-]*(?:study|treatment)\s+(?:only|visit)", "Single", 0.85),
    (r"(?:at\s+)?(?:final|termination|discontinuation)\s+visit", "Single", 0.85),
    (r"(?:biopsy|surgery|procedure|implantation)", "Single", 0.75),
    (r"(?:genetic|genomic)\s+(?:testing|analysis|sampling)", "Single", 0.80),
    (r"(?:informed\s+consent|icf)", "Single", 0.90),
    (r"(?:randomization|stratification)", "Single", 0.85),
    (r"(?:device|implant)\s+(?:insertion|implantation|placement)", "Single", 0.85),
    (r"at\s+(?:each|every|all)\s+(?:\w+\s+)?(?:visit|encounter|timepoint)", "Recurring", 0.85),
    (r"(?:at\s+)?each\s+(?:\w+\s+)?visit", "Recurring", 0.85),
    (r"(?:recorded|measured|assessed|performed)\s+at\s+(?:each|every|all)", "Recurring", 0.80),
    (r"(?:weekly|monthly|quarterly|biweekly)\s+(?:assessment|visit|evaluation|monitoring)", "Recurring", 0.85),
    (r"every\s+(?:\d+\s+)?(?:week|month|visit)", "Recurring", 0.80),
    (r"(?:q\d+w|q\d+m)", "Recurring", 0.80),
    (r"(?:vital\s+signs?|vitals)\s+(?:at\s+)?(?:each|every)\s+visit", "Recurring", 0.90),
    (r"(?:physical\s+exam(?:ination)?|pe)\s+(?:at\s+)?(?:each|every)\s+visit", "Recurring", 0.85),
    (r"(?:adverse\s+events?|ae)\s+(?:assessment|review|collection)", "Recurring", 0.80),
    (r"(?:concomitant\s+medications?|con\s*meds?)\s+(?:review|assessment)", "Recurring", 0.80),
    (r"(?:laboratory|lab)\s+(?:tests?|assessments?)\s+(?:at\s+)?(?:each|every|scheduled)", "Recurring", 0.85),
    (r"(?:chemistry|hematology|urinalysis)\s+(?:at\s+)?(?:each|every)\s+visit", "Recurring", 0.85),
    (r"(?:at|on)\s+(?:day\s+1\s+of\s+)?each\s+cycle", "Recurring", 0.90),
    (r"(?:every|each)\s+cycle", "Recurring", 0.85),
    (r"(?:tumor|disease)\s+(?:assessment|evaluation)\s+every\s+\d+\s+(?:weeks?|cycles?)", "Recurring", 0.85),
    (r"(?:questionnaire|pro|epro|diary)\s+(?:at\s+)?(?:each|every)\s+visit", "Recurring", 0.85),
    (r"(?:patient|subject)\s+(?:reported|diary)\s+(?:at\s+)?(?:each|scheduled)", "Recurring", 0.80),
)

# Pattern, sign of a crossover design, confidence.
CROSSOVER: tuple[Rule, ...] = (
    (r"crossover\s+(?:study|design|trial)", "design", 0.95),
    (r"cross[\-\s]?over\s+(?:study|design|trial)", "design", 0.95),
    (r"(?:2|two|3|three)[\-\s]?(?:way|period|sequence)\s+crossover", "design", 0.95),
    (r"(?:open[\-\s]?label\s+)?crossover", "design", 0.90),
    (r"period\s+[12]\s+(?:and|&)\s+period\s+[12]", "period", 0.90),
    (r"treatment\s+period\s+[12]", "period", 0.85),
    (r"(?:first|second)\s+treatment\s+period", "period", 0.85),
    (r"sequence\s+[ab]{2,}", "sequence", 0.90),
    (r"treatment\s+sequence\s+(?:[ab]{2,}|[12]{2,})", "sequence", 0.90),
    (r"randomized?\s+to\s+(?:sequence|treatment\s+order)", "sequence", 0.85),
    (r"washout\s+period", "washout", 0.85),
    (r"wash[\-\s]?out\s+(?:of\s+)?\d+\s*(?:days?|weeks?)", "washout", 0.90),
    (r"(?:\d+[\-\s]?(?:day|week))\s+washout", "washout", 0.90),
    (r"between[\-\s]?period\s+washout", "washout", 0.85),
)

# Patterns of a titration within subjects or of a single arm; two of them rule a crossover out.
NOT_CROSSOVER = (
    r"dose\s+titration",
    r"titrat(?:e|ion|ed)\s+(?:to|from)",
    r"dose\s+escalation",
    r"escalat(?:e|ion|ed)\s+(?:to|from)",
    r"(\d+)\s*mg.*?(?:for|during).*?(\d+)\s*days?.*?(?:then|followed\s+by).*?(\d+)\s*mg",
    r"starting\s+dose.*?(?:increase|titrate|escalate)",
    r"initial\s+dose.*?(?:increase|titrate|escalate)",
    r"dose\s+adjustment",
    r"within[\-\s]?subject\s+(?:dose|titration)",
    r"single[\-\s]?arm",
    r"open[\-\s]?label(?:\s+single)",
    r"all\s+(?:subjects?|participants?)\s+(?:will\s+)?receive",
    r"no\s+(?:control|placebo|comparator)\s+(?:arm|group)",
)

# Patterns whose first group is a sequence of treatments.
SEQUENCES = (
    r"sequence\s+([ab]{2,})",
    r"treatment\s+sequence\s+([ab]{2,})",
    r"sequence\s+([12]{2,})",
    r"((?:ab|ba|abc|acb|bac|bca|cab|cba)\s+sequence)",
)

# Patterns whose first group is the length of a washout, in order of precedence.
WASHOUTS = (
    r"washout\s+(?:period\s+)?(?:of\s+)?(\d+)\s*(?:days?)",
    r"washout\s+(?:period\s+)?(?:of\s+)?(\d+)\s*(?:weeks?)",
    r"(\d+)[\-\s]?(?:day|week)\s+washout",
    r"(?:minimum|at\s+least)\s+(\d+)\s*(?:days?|weeks?)\s+washout",
    r"washout\s+(?:of\s+)?(?:at\s+least\s+)?(\d+)",
)

# Pattern, type of endpoint, confidence, in order of precedence.
ENDPOINT_TYPES: tuple[Rule, ...] = (
    (r"primary\s+(?:efficacy\s+)?endpoint", "Primary", 0.95),
    (r"primary\s+(?:study\s+)?objective", "Primary", 0.90),
    (r"secondary\s+(?:efficacy\s+)?endpoint", "Secondary", 0.95),
    (r"secondary\s+(?:study\s+)?objective", "Secondary", 0.90),
    (r"exploratory\s+endpoint", "Exploratory", 0.90),
    (r"safety\s+endpoint", "Safety", 0.90),
    (r"key\s+secondary", "Secondary", 0.85),
)

# Inputs of endpoints.
ENDPOINT_INPUTS = (
    "glucose", "PG", "HbA1c", "fasting glucose", "insulin", "tumor size", "ORR", "PFS", "OS", "CR", "PR", "blood pressure", "systolic", "diastolic", "LDL", "HDL",
    "cognitive score", "MMSE", "ADAS-Cog", "ACR20", "ACR50", "ACR70", "DAS28",
)

# Patterns whose first group tells an endpoint's success.
SUCCESS = (
    r"success(?:ful)?\s+(?:is\s+)?(?:defined\s+as|if)\s+([^.]+)",
    r"responder\s+(?:is\s+)?(?:defined\s+as)\s+([^.]+)",
    r"(?:achieve|achieving)\s+([^.]+)",
    r"criterion\s+(?:for\s+success)?[:\s]+([^.]+)",
)

# Patterns whose first group tells what an endpoint's time counts from.
TIME_REFERENCES = (
    r"(?:from|after|following)\s+(\w+(?:\s+\w+)?(?:\s+administration)?)",
    r"(?:at|by)\s+(week\s+\d+|day\s+\d+|baseline)",
    r"(post[- ]?dose|pre[- ]?dose)",
)

# Patterns whose first group is an endpoint's formula.
ENDPOINT_FORMULAS = (
    r"(?:calculated|computed|defined)\s+as\s+[:\s]*([^.]+)",
    r"formula[:\s]+([^.]+)",
    r"=\s*([^.]+)",
)

# Pattern, type of a derived variable, confidence, in order of precedence.
VARIABLE_TYPES: tuple[Rule, ...] = (
    (r"change\s+from\s+baseline", "ChangeFromBaseline", 0.95),
    (r"percent(?:age)?\s+change", "PercentChange", 0.95),
    (r"time\s+to\s+(?:first\s+)?(?:event|occurrence)", "TimeToEvent", 0.90),
    (r"baseline\s+(?:value|measurement)", "Baseline", 0.90),
    (r"categorical|binary|dichotomous", "Categorical", 0.85),
    (r"composite\s+(?:endpoint|score|variable)", "Composite", 0.90),
)

# Words one of which a section about a derived variable has.
VARIABLE_WORDS = ("baseline", "change", "derived", "calculated", "variable")

# Patterns of names of derived variables, in order of precedence.
VARIABLE_NAMES = (
    r"(?:derived|analysis|efficacy)\s+variable[:\s]+([^.]+)",
    r"change\s+from\s+baseline\s+(?:in\s+)?(\w+(?:\s+\w+)?)",
    r"(\w+(?:\s+\w+)?)\s+(?:is\s+)?(?:defined|calculated|derived)",
)

# Patterns of a baseline's definition, in order of precedence; the whole match where there is no group.
BASELINES = (
    r"baseline\s+(?:is\s+)?(?:defined\s+as|=)\s+([^.]+)",
    r"last\s+(?:non-?missing\s+)?(?:value|observation)\s+(?:before|prior\s+to)\s+([^.]+)",
    r"((?:day\s*-?\d+|screening|randomization)\s+(?:value|measurement))",
    r"(pre-?(?:dose|treatment|randomization)\s+(?:value|measurement))",
)

# Patterns of a baseline's visit, in order of precedence.
BASELINE_VISITS = (
    r"((?:at\s+)?(?:day\s*-?\d+))",
    r"((?:at\s+)?screening)",
    r"((?:at\s+)?randomization)",
    r"((?:at\s+)?(?:visit\s+\d+))",
)

# Patterns whose first group is a variable's derivation, and the derivations of types without one.
DERIVATIONS = (
    r"(?:calculated|computed|derived)\s+(?:as|by)\s+[:\s]*([^.]+)",
    r"formula[:\s]+([^.]+)",
    r"=\s*([^.]+)",
)
DERIVATION_OF_TYPE = {
    "ChangeFromBaseline": "post_value - baseline_value",
    "PercentChange": "((post_value - baseline_value) / baseline_value) * 100",
    "TimeToEvent": "event_date - reference_date",
}

# Patterns of an analysis window, in order of precedence.
ANALYSIS_WINDOWS = (
    r"((?:at\s+)?week\s+\d+\s*(?:±\s*\d+\s*days?)?)",
    r"((?:at\s+)?day\s+\d+\s*(?:±\s*\d+\s*days?)?)",
    r"((?:at\s+)?month\s+\d+)",
    r"((?:between\s+)?(?:day|week)\s+\d+\s+(?:and|to)\s+(?:day|week)\s+\d+)",
)

# Pattern and method of imputation, in order of precedence.
IMPUTATIONS = (
    (r"locf|last\s+observation\s+carried\s+forward", "LOCF"),
    (r"mmrm|mixed\s+(?:model|effect)", "MMRM"),
    (r"multiple\s+imputation", "MI"),
    (r"worst\s+case", "worst_case"),
    (r"baseline\s+carried\s+forward", "BCF"),
)

# Epochs of a study in order, and their patterns.
EPOCHS = (
    ("SCREENING", r"screening\s+(?:period|phase|epoch|visit)?"),
    ("RUN_IN", r"run[\-\s]?in\s+(?:period|phase)?"),
    ("LEAD_IN", r"lead[\-\s]?in\s+(?:period|phase)?"),
    ("BASELINE", r"baseline\s+(?:period|phase|visit)?"),
    ("TREATMENT", r"(?:active\s+)?treatment\s+(?:period|phase|epoch)?"),
    ("MAINTENANCE", r"maintenance\s+(?:period|phase)?"),
    ("WASHOUT", r"washout\s+(?:period|phase)?"),
    ("FOLLOW_UP", r"follow[\-\s]?up\s+(?:period|phase|epoch)?"),
    ("EXTENSION", r"(?:open[\-\s]?label\s+)?extension\s+(?:period|phase)?"),
    ("END_OF_STUDY", r"end[\-\s]?of[\-\s]?(?:study|treatment)"),
)

# Epochs of a text that names none.
DEFAULT_EPOCHS = ("SCREENING", "TREATMENT", "FOLLOW_UP", "END_OF_STUDY")

# Visits that are mandatory where a text names them; Screening always is.
MANDATORY_VISITS = (
    (r"day\s+1", "Day 1"),
    (r"baseline\s+visit", "Baseline"),
    (r"randomization\s+visit", "Randomization"),
    (r"end[\-\s]?of[\-\s]?(?:study|treatment)\s+visit", "End of Study"),
    (r"(?:final|termination)\s+visit", "End of Study"),
    (r"(?:30|28)[\-\s]?day\s+(?:safety\s+)?follow[\-\s]?up", "Safety Follow-up"),
)

# Patterns of an early exit.
EARLY_EXITS = (
    r"early\s+(?:termination|discontinuation|withdrawal)",
    r"premature\s+(?:termination|discontinuation)",
    r"(?:discontinue|withdraw)\s+(?:from\s+)?(?:the\s+)?study",
    r"(?:if|when)\s+(?:the\s+)?subject\s+(?:discontinues|withdraws)",
    r"(?:early|premature)\s+exit",
)

# Pattern of a procedure at an early exit, and its name.
EXIT_PROCEDURES = (
    (r"early\s+termination\s+visit", "Early Termination Visit"),
    (r"(?:30|28)[\-\s]?day\s+(?:safety\s+)?follow[\-\s]?up", "30-Day Follow-up"),
    (r"end[\-\s]?of[\-\s]?treatment\s+(?:visit|assessment)", "End of Treatment"),
    (r"safety\s+follow[\-\s]?up", "Safety Follow-up"),
)

# Measurements that derived variables come from.
MEASUREMENTS = (
    "glucose", "HbA1c", "blood pressure", "heart rate", "weight", "BMI", "creatinine", "ALT", "AST", "hemoglobin", "platelet", "WBC", "neutrophil", "tumor size", "PSA", "CA-125",
)
