"""Community sets, category maps, word lists, release dates.

Every operator takes these as arguments; the names below are the defaults.
"""

from __future__ import annotations

# --- fixed values: communities -------------------------------------------------------------
INGEST_COMMUNITIES = [
    "ChatGPT", "OpenAI", "GPT4", "ClaudeAI", "PerplexityAI",
    "StableDiffusion", "MidJourney", "Sora", "AIArt",
    "GenerativeAI", "ArtificialIntelligence", "MachineLearning",
    "computerscience", "datascience", "programming",
    "Futurology", "singularity", "neoliberal",
    "LocalLLaMA", "OpenAI_Dev",
    "AskReddit",
]
BASELINE_COMMUNITY = "AskReddit"
POLITICAL_COMMUNITY = "neoliberal"
AI_CORE_COMMUNITIES = [c for c in INGEST_COMMUNITIES if c != BASELINE_COMMUNITY]
TECH_COMMUNITIES = [
    "ChatGPT", "ClaudeAI", "PerplexityAI", "OpenAI", "GPT4", "LocalLLaMA", "StableDiffusion",
    "MachineLearning", "datascience", "programming", "computerscience",
    "Futurology", "neoliberal", "singularity",
]

# --- fixed values: community -> category ---------------------------------------------------
SIX_WAY_CATEGORY = {
    "chatbot_focused": ["ChatGPT", "OpenAI", "GPT4", "ClaudeAI", "PerplexityAI"],
    "creative_generation": ["StableDiffusion", "MidJourney", "Sora", "AIArt"],
    "research_technical": [
        "GenerativeAI", "ArtificialIntelligence", "MachineLearning",
        "computerscience", "datascience", "programming",
    ],
    "social_policy": ["Futurology", "singularity", "neoliberal"],
    "dev_hardcore": ["LocalLLaMA", "OpenAI_Dev"],
    "baseline_control": ["AskReddit"],
}
FOUR_WAY_CATEGORY = {
    "Text AI": ["chatgpt", "openai", "claudeai", "gpt4", "localllama"],
    "Creative AI": ["stablediffusion"],
    "Research/Tech": [
        "machinelearning", "datascience", "computerscience", "programming", "singularity", "futurology",
    ],
}
FIVE_WAY_SUBSTRINGS = {
    "Baseline (AskReddit)": ["askreddit"],
    "Text AI": ["chatgpt", "openai", "gpt4", "claude", "perplexity"],
    "Creative AI": ["midjourney", "stablediffusion", "sora", "aiart"],
    "Research/Tech": ["generativeai", "artificialintelligence", "machinelearning"],
}
COARSE_SUBSTRINGS = {
    "Baseline": ["askreddit"],
    "Text AI": ["chatgpt", "openai", "gpt"],
    "Creative AI": ["midjourney", "stable"],
    "Research/Tech": ["machine", "data", "tech"],
}
BASELINE_MENTION_LABEL = "Baseline (AskReddit - AI mentioned)"
AI_TOOLS = ["ChatGPT", "OpenAI", "GPT4", "ClaudeAI", "PerplexityAI"]
AI_TOOL_MENTIONS = [
    # text tools
    "chatgpt", "gpt-3", "gpt-4", "gpt3", "gpt4", "openai", "claude", "perplexity", "bard", "gemini",
    "copilot", "github copilot",
    # creative tools
    "midjourney", "stable diffusion", "stablediffusion", "dall-e", "dalle", "sora", "ai art", "aiart",
    "runway", "pika", "leonardo",
    # general terms
    "generative ai", "generativeai", "artificial intelligence", "machine learning", "deep learning",
    "neural network", "llm", "large language model", "diffusion model",
]

# --- fixed values: emotion words -----------------------------------------------------------
EMOTION_KEYWORDS = {
    "joy": [
        "happy", "glad", "excited", "awesome", "amazing", "great", "fun",
        "enjoy", "enjoying", "enjoyed", "cool", "yay", "love", "lmao",
    ],
    "love": [
        "love", "adore", "admire", "cherish", "favorite", "favourite", "loving", "loved", "wholesome",
    ],
    "anger": [
        "angry", "mad", "furious", "rage", "raging", "annoyed", "annoying", "pissed", "hate", "hating",
        "hated", "frustrated", "frustrating", "stupid", "dumb", "idiot", "idiotic",
    ],
    "fear": [
        "afraid", "scared", "terrified", "worried", "anxious", "anxiety", "fear", "fearful", "panic",
        "panicking", "danger",
    ],
    "sadness": [
        "sad", "depressed", "depressing", "unhappy", "crying", "cried", "tears", "miserable", "lonely",
        "heartbroken",
    ],
    "surprise": [
        "surprised", "shocked", "shocking", "wow", "omg", "unexpected", "suddenly", "didnt", "didn't",
        "never thought",
    ],
}
NEUTRAL = "neutral"
EMOTION_LABELS = [*EMOTION_KEYWORDS, NEUTRAL]

# --- fixed values: word -> emotions of the nine-part emotion vector --------------------------
EMOTION_VECTOR_LABELS = [
    "joy", "sadness", "anger", "fear", "surprise", "anticipation", "trust", "positive", "negative",
]
EMOTION_VECTOR_WORDS = {
    "happy": ["joy"],
    "joy": ["joy"],
    "love": ["joy", "trust"],
    "excited": ["joy", "anticipation"],
    "win": ["joy"],
    "great": ["joy", "positive"],
    "amazing": ["joy", "positive"],
    "cool": ["joy", "positive"],
    "beautiful": ["joy", "positive"],
    "fear": ["fear"],
    "scared": ["fear"],
    "threat": ["fear"],
    "risk": ["fear"],
    "unsafe": ["fear"],
    "angry": ["anger"],
    "rage": ["anger"],
    "mad": ["anger"],
    "hate": ["anger", "negative"],
    "furious": ["anger"],
    "sad": ["sadness"],
    "loss": ["sadness"],
    "cry": ["sadness"],
    "depressed": ["sadness"],
    "shock": ["surprise"],
    "surprised": ["surprise"],
    "unexpected": ["surprise"],
    "bad": ["negative"],
    "wrong": ["negative"],
    "problem": ["negative", "fear"],
    "danger": ["fear"],
    "fail": ["negative"],
    "terrible": ["negative"],
    "trust": ["trust"],
    "secure": ["trust"],
    "safe": ["trust"],
    "anticipate": ["anticipation"],
    "future": ["anticipation"],
}

# --- fixed values: survey benefits ---------------------------------------------------------
BENEFIT_KEYWORDS = {
    "Less time searching": [
        "search", "searching", "googling", "google", "stackoverflow", "docs", "documentation",
    ],
    "Faster coding": ["faster", "fast", "speed", "speedup", "quickly", "autocomplete", "boilerplate"],
    "Repetitive tasks": ["repetitive", "boilerplate", "tedious", "repeating", "repeat", "copy", "paste"],
    "Increased productivity": [
        "productivity", "productive", "more", "efficient", "efficiency", "workflow", "get", "done",
    ],
    "Faster learning": [
        "learn", "learning", "learned", "tutorial", "explain", "explanation", "walkthrough",
    ],
    "Less mental effort": [
        "mental", "effort", "brain", "tiring", "thinking", "cognitive", "overwhelming",
    ],
    "Better experience": ["experience", "developer", "dev", "dx", "user", "ux"],
    "Better code quality": [
        "code", "quality", "cleaner", "clean", "refactor", "refactoring", "bugs", "bugfree",
    ],
}
SURVEY_TO_BENEFIT = {
    "Less time spent searching for information": "Less time searching",
    "Faster coding and development": "Faster coding",
    "Faster completion of repetitive tasks": "Repetitive tasks",
    "Increased productivity": "Increased productivity",
    "Faster learning of new technologies, frameworks, languages, etc.": "Faster learning",
    "Less mental effort required for coding and development": "Less mental effort",
    "Better coding and development experience": "Better experience",
    "Better quality of code and development solutions": "Better code quality",
}

# --- fixed values: the English stop words that Spark MLlib ships ------------------------------
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself", "they",
    "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these", "those",
    "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does",
    "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at",
    "by", "for", "with", "about", "against", "between", "into", "through", "during", "before", "after", "above",
    "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then",
    "once", "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more", "most",
    "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t",
    "can", "will", "just", "don", "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll",
    "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't", "haven't",
    "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't", "mustn't",
    "can't", "couldn't", "cannot", "could", "here's", "how's", "let's", "ought", "that's", "there's", "what's",
    "when's", "where's", "who's", "why's", "would",
]

# --- fixed values: stop words added to Spark's English list ----------------------------------
TOPIC_STOP_WORDS = [
    "people", "person", "someone", "everyone", "anyone", "thing", "things", "stuff",
    "like", "get", "got", "give", "take", "make", "made", "put", "keep", "let",
    "know", "think", "feel", "look", "see", "say", "said", "tell", "told",
    "go", "went", "come", "came", "back", "away", "around", "really", "actually",
    "even", "still", "always", "never", "ever", "maybe", "probably", "kinda", "sort",
    "just", "also", "very", "so", "too", "lot", "lots", "many", "much", "more", "less",
    "time", "day", "year", "years", "week", "weeks", "month", "months", "hour", "hours",
    "today", "yesterday", "tomorrow", "now", "ago", "long", "later", "early", "late",
    "i", "im", "i'm", "ive", "i've", "id", "i'd",
    "you", "youre", "you're", "youve", "you've", "youd", "you'd",
    "we", "weve", "we've", "they", "theyre", "they're", "them", "their", "theirs",
    "he", "him", "his", "she", "her", "hers", "it", "its", "it’s",
    "my", "mine", "your", "yours", "our", "ours", "us", "u",
    "one", "ones", "someone", "anyone", "everyone", "noone",
    "re", "ve", "ll", "m", "d", "s",
    "dont", "don't", "didnt", "didn't", "doesnt", "doesn't",
    "cant", "can't", "couldnt", "couldn't", "wouldnt", "wouldn't",
    "wont", "won't", "isnt", "isn't", "arent", "aren't", "wasnt", "wasn't",
    "should", "could", "would", "must", "might", "may", "shall",
    "yeah", "yes", "no", "oh", "well", "ok", "okay", "hmm", "uh", "uhh", "uhm", "huh",
    "lol", "lmao", "haha", "ahah", "wow", "nah", "guess", "kinda", "sorta",
    "r", "askreddit", "reddit", "subreddit", "thread", "threads", "comment", "comments",
    "post", "posts", "posting", "message", "messages", "inbox",
    "rule", "rules", "wiki", "index", "contact", "automatically", "action", "mod", "mods",
    "http", "https", "www", "com", "net", "org", "io", "jpg", "jpeg", "png", "gif", "html",
    "link", "links", "url", "site", "page", "video", "youtube", "yt", "preview", "format",
    "good", "bad", "best", "better", "worse", "nice", "cool", "great", "awesome", "amazing",
    "kind", "type", "sort", "maybe", "probably", "literally",
    "else", "anything", "something", "nothing", "everything",
]
SMALL_TOPIC_STOP_WORDS = [
    "im", "dont", "cant", "wont", "didnt", "isnt", "thats", "youre", "ive",
    "http", "https", "com", "www", "reddit", "subreddit", "post", "comment", "bot", "moderator", "mod",
    "deleted", "removed", "please", "contact", "message", "action",
    "like", "just", "get", "got", "one", "time", "people", "think", "know", "make", "really", "good",
    "bad", "much", "many", "well", "see", "way", "use", "also", "even", "now", "go", "going", "want",
    "would", "could",
]
MODEL_STOP_WORDS = [
    "http", "https", "www", "com", "net", "org", "io", "jpg", "jpeg", "png", "gif", "html",
    "link", "links", "url", "site", "page", "video", "videos", "youtube", "yt", "preview", "format",
    "amp", "lt", "gt",
]

# --- fixed values: user segments and release dates -------------------------------------------
CLUSTER_PERSONAS = {
    0: "Power devs: coding help & debugging",
    1: "Prompt experimenters & jailbreak crowd",
    2: "Career & job search / upskilling",
    3: "Tool comparisons & which AI should I use?",
    4: "Product feedback, reliability & bug reports",
    5: "Creators & marketers (content generation)",
    6: "Students & learners (homework / studying)",
    7: "Ethics, safety & policy debates",
    8: "API / integrations & plugins builders",
    9: "General chat / off-topic exploration",
}
RELEASE_EVENTS = [
    ("Claude 2", "2023-07-11"),
    ("Stable Diffusion XL", "2023-07-26"),
    ("GPT-4 Turbo", "2023-11-06"),
    ("Claude 3", "2024-03-04"),
    ("GPT-4o", "2024-05-13"),
]

# --- fixed values: sentinels -----------------------------------------------------------------
DELETED = "[deleted]"
REMOVED = "[removed]"
