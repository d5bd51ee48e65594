"""Parameters of the terminal models; the defaults are those of the terminal that the models were made for."""

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Config:
    capacity: int = 3
    terminal_name: str = "Sabine Pass LNG"
    #: Minutes.
    call_gap: float = 120.0
    episode_gap: float = 20.0
    call_margin: float = 120.0
    least_call: float = 30.0
    edge: float = 10.0
    outage_slack: float = 5.0
    least_positions: int = 3
    least_history: int = 5
    stationary_speed: float = 0.5
    #: Probable calls: minutes, mean speed, closest distance, vessel types, length, width.
    probable: tuple[float, float, float, tuple[int, int], float, float] = (360, 1.0, 2000, (80, 89), 250, 40)
    #: Score: points for each signal at full strength.
    weights: dict[str, float] = field(default_factory=lambda: {
        "capacity": 20.0, "saturation": 10.0, "active_delay": 20.0, "active_severe": 15.0, "delay_intensity": 10.0, "utilisation_3d": 15.0, "backlog": 10.0})
    levels: tuple[tuple[float, str], ...] = ((25, "low"), (50, "moderate"), (70, "elevated"), (85, "high"))
    top_level: str = "critical"
    full_delay_hours: float = 24.0
    full_backlog: float = 2.0


DEFAULT = Config()
