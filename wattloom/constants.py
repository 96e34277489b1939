"""Values that meter systems fix; all of them are parameters of the operators."""

# Condition codes of a regular reading, in the source and in the target.
REGULAR_SOURCE_CODES = ("501000", "501001", "501002", "501003", "501004", "501005", "501006", "501007", "501008")
REGULAR_TARGET_CODES = ("501000",)

# Flags of quarantined readings and the usage types they stand for.
USAGE_FLAGS = (("D1SC", "scalar"), ("D1IN", "interval"))

# Units and register prefix of energy, and the registers that are audited.
ENERGY_UNITS = ("KWH", "KW")
ENERGY_REGISTER_PREFIX = "E-KW"
AUDITED_REGISTERS = ("E-KWH-15-DEL", "E-KWH-15-REC")

# Intervals of a day and their length in minutes.
INTERVALS_A_DAY = 96
INTERVAL_MINUTES = 15

# Issues that alerts name; the last two take the percentage.
ISSUE_BOTH = "SOURCE AND TARGET ISSUE"
ISSUE_SOURCE = "SOURCE ISSUE"
ISSUE_TARGET = "TARGET ISSUE"
ISSUE_SOURCE_QUALITY = "SOURCE NON REGULAR INTERVAL COUNT > {:g}%"
ISSUE_TARGET_QUALITY = "TARGET NON REGULAR INTERVAL COUNT > {:g}%"
NO_ISSUE = "NO ISSUE"
