"""Query parameters for the ``events`` table.

The reference's durations are for one click per second; ``events`` has one
event every ~260 s (sf0.01), so every duration is scaled by 360:
10 s -> 1 h, 5 s -> 30 min, 2 s -> 12 min, 1 s -> 6 min, 1 min -> 6 h.
Operators take durations as arguments; golden-transcript tests use the
original values.
"""

SCALE = 360
SEC = 1000 * SCALE          # one reference second, scaled

TUMBLE_USER_MS = 5 * SEC            # W1: 5 s tumbling per user
SLIDE_PVUV_SIZE_MS = 10 * SEC       # W2: 10 s / 2 s sliding pv/uv
SLIDE_PVUV_STEP_MS = 2 * SEC
UV_SIZE_MS = 10 * SEC               # W3: 10 s tumbling uv
URL_SIZE_MS = 10 * SEC              # W4: 10 s / 5 s sliding per url
URL_STEP_MS = 5 * SEC
WM_WINDOW_MS = 10 * SEC             # W5: 10 s tumbling, 5 s bounded delay
WM_DELAY_MS = 5 * SEC
TRIGGER_WINDOW_MS = 10 * SEC        # W6: 10 s tumbling, timer every 1 s
TRIGGER_STEP_MS = 1 * SEC
LATE_WINDOW_MS = 10 * SEC           # W7: 10 s tumbling, 2 s delay, 1 min lateness
LATE_DELAY_MS = 2 * SEC
LATE_LATENESS_MS = 60 * SEC
TIMER_DELAY_MS = 5 * SEC            # PF2: processing-time timer 5 s after arrival

# Stand-ins for the reference's named users: the click view's users are
# user ids as text.
MARY = "1"
BOB = "2"

# Fixed "now" for the index router (2024-01-23T08:53:20Z), inside the
# events' time range so both routes occur.
NOW_MS = 1_706_000_000_000
