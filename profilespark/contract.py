"""The contract: which columns a labelled table has and what is valid in them.

Every operator takes a DataFrame plus a `Contract`, so the same code runs on the
survey schema and on any other table for which a binding is declared.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Contract:
    """Columns, bounds, aliases and label order shared by every operator."""

    name: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    target: str | None = None
    labels: tuple[str, ...] = ()
    bounds: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    aliases: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    display_names: Mapping[str, str] = field(default_factory=dict)
    #: validated and reported, but never fed to a classifier or to clustering
    report_only: tuple[str, ...] = ()
    #: outcome-like columns that must never reach a feature matrix
    excluded: tuple[str, ...] = ()
    #: strict integers in scoring requests
    integers: tuple[str, ...] = ()
    #: stable row identity, carried next to the features
    row_id: str | None = None
    #: statements that travel with every fitted bundle and every score
    limitations: tuple[str, ...] = ()
    max_text_length: int = 80
    min_class_rows: int = 15
    seed: int = 42

    def __post_init__(self) -> None:
        overlap = set(self.numeric) & set(self.categorical)
        if overlap:
            raise ValueError(f"Columns both numeric and categorical: {sorted(overlap)}")
        if self.target in self.features:
            raise ValueError(f"Target {self.target!r} must not be a feature")
        if len(set(self.labels)) != len(self.labels):
            raise ValueError("Labels must be distinct")

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    @property
    def model_numeric(self) -> tuple[str, ...]:
        return tuple(c for c in self.numeric if c not in self.report_only)

    @property
    def model_features(self) -> tuple[str, ...]:
        return self.model_numeric + self.categorical

    def display(self, column: str) -> str:
        return self.display_names.get(column, column)

    def with_(self, **changes) -> "Contract":
        return replace(self, **changes)


# The statements that travel with every survey score.
SURVEY_LIMITATIONS = (
    "Educational estimates of dataset labels, not a clinical assessment.",
    "Dataset source, license, collection method, and synthetic status are unverified.",
    "Age is accepted for validation and reporting but excluded from prediction because training ages cover only 18-24.",
    "Performance across demographic age groups remains unverified without representative labeled data.",
    "Probabilities are uncalibrated model outputs.",
    "Study and physical-activity time windows need source confirmation.",
    "Global feature importance and input comparisons do not establish individual causes.",
)

# Fixed values of the survey schema: column names, bounds, aliases, label order.
SURVEY = Contract(
    name="survey",
    numeric=(
        "Age",
        "Avg_Daily_Usage_Hours",
        "Daily_Unlocks",
        "Study_Hours",
        "Physical_Activity_Hours",
        "Sleep_Hours_Per_Night",
    ),
    categorical=("Academic_Level", "Most_Used_Platform", "Purpose_Of_Use"),
    target="Stress_Level",
    labels=("Low", "Medium", "High", "Very High"),
    bounds={
        "Age": (13, 120),
        "Avg_Daily_Usage_Hours": (0, 24),
        "Daily_Unlocks": (0, 2000),
        "Study_Hours": (0, 24),
        "Physical_Activity_Hours": (0, 24),
        "Sleep_Hours_Per_Night": (0, 24),
    },
    aliases={
        "Academic_Level": {"Postgraduate": "Graduate"},
        "Purpose_Of_Use": {
            "Academic": "Education",
            "Social": "Networking",
            "Browsing": "News",
        },
    },
    display_names={
        "Age": "Age",
        "Avg_Daily_Usage_Hours": "Daily social-media hours",
        "Daily_Unlocks": "Daily phone unlocks",
        "Study_Hours": "Study hours",
        "Physical_Activity_Hours": "Physical-activity hours",
        "Sleep_Hours_Per_Night": "Sleep hours per night",
        "Academic_Level": "Academic level",
        "Most_Used_Platform": "Main platform",
        "Purpose_Of_Use": "Main purpose",
    },
    report_only=("Age",),
    excluded=("Gender", "Country", "Mental_Health_Score"),
    integers=("Age", "Daily_Unlocks"),
    limitations=SURVEY_LIMITATIONS,
)

# Right-closed age groups; the first group includes its lower edge.
AGE_EDGES = (12, 17, 24, 34, 44, 59, 120)
AGE_GROUPS = ("13-17", "18-24", "25-34", "35-44", "45-59", "60-120")
