"""Lookup tables, labels and thresholds that results depend on."""

# Former name -> current name.
TEAM_NAMES = {
    "Delhi Daredevils": "Delhi Capitals",
    "Deccan Chargers": "Sunrisers Hyderabad",
    "Kings XI Punjab": "Punjab Kings",
    "Rising Pune Supergiant": "Rising Pune Supergiants",
    "Pune Warriors": "Rising Pune Supergiants",
    "Gujarat Lions": "Gujarat Titans",
}

# Team -> home cities.
HOME_CITIES = {
    "Chennai Super Kings": ["Chennai"],
    "Mumbai Indians": ["Mumbai"],
    "Delhi Capitals": ["Delhi"],
    "Kolkata Knight Riders": ["Kolkata"],
    "Royal Challengers Bangalore": ["Bengaluru"],
    "Sunrisers Hyderabad": ["Hyderabad"],
    "Rajasthan Royals": ["Jaipur"],
    "Punjab Kings": ["Chandigarh", "Mohali"],
    "Kings XI Punjab": ["Chandigarh", "Mohali"],
    "Gujarat Titans": ["Ahmedabad"],
    "Rising Pune Supergiant": ["Pune"],
    "Pune Warriors": ["Pune"],
    "Deccan Chargers": ["Hyderabad"],
    "Gujarat Lions": ["Rajkot"],
    "Kochi Tuskers Kerala": ["Kochi"],
}

# Last over of each phase, and the phase labels.
POWERPLAY_END = 6
MIDDLE_END = 15
PHASES = ("Powerplay", "Middle Overs", "Death Overs")

# Text between the two names of a pairing.
PAIR_SEPARATOR = " vs "

# Digits of a rate, rate without history, decision threshold.
RATE_DIGITS = 3
NO_HISTORY_RATE = 0.5
FIELD_THRESHOLD = 0.6

# Splits and seeds.
MODEL_TRAIN_PERCENT = 80
REQUEST_TRAIN_PERCENT = 70
SPLIT_SEED = 42
PERCEPTRON_SEED = 123
