"""Disease profiles of the dataset builder."""

from __future__ import annotations

from typing import NamedTuple


class Draw(NamedTuple):
    """Bounds, mean and standard deviation of one measure."""

    low: float
    high: float
    mean: float
    sd: float


class Profile(NamedTuple):
    disease: str
    weight: int  # percent
    age: Draw
    bmi: Draw
    bp_systolic: Draw
    glucose: Draw
    cholesterol: Draw
    sleep_hours: Draw
    stress: tuple[int, ...]  # percent, clinical order
    activity: tuple[int, ...]
    smoking: tuple[int, ...]
    alcohol: tuple[float, float]  # mean, standard deviation


# One profile per disease; weights and category shares are percentages.
PROFILES = (
    Profile("Healthy", 20, Draw(18, 50, 35, 8), Draw(18.5, 24.9, 22, 1.8), Draw(90, 119, 105, 8),
            Draw(70, 99, 85, 8), Draw(120, 199, 165, 18), Draw(7, 9, 7.5, 0.5),
            (70, 25, 5), (5, 20, 45, 30), (85, 12, 3), (1.5, 1.2)),
    Profile("Diabetes_Type2", 12, Draw(45, 80, 62, 10), Draw(30, 45, 35, 4), Draw(130, 180, 148, 12),
            Draw(150, 280, 195, 30), Draw(200, 320, 248, 25), Draw(4, 7, 5.5, 0.9),
            (15, 40, 45), (60, 30, 8, 2), (35, 35, 30), (4.2, 2.5)),
    Profile("Heart_Disease", 10, Draw(50, 85, 66, 9), Draw(26, 40, 31, 4), Draw(145, 200, 168, 15),
            Draw(100, 180, 122, 20), Draw(230, 350, 278, 30), Draw(4, 7, 5.9, 0.9),
            (10, 35, 55), (65, 25, 8, 2), (25, 30, 45), (6.5, 3.2)),
    Profile("Hypertension", 15, Draw(40, 75, 57, 10), Draw(25, 38, 29, 4), Draw(145, 190, 158, 12),
            Draw(85, 140, 104, 15), Draw(180, 280, 218, 22), Draw(5, 8, 6.6, 0.8),
            (20, 50, 30), (45, 35, 15, 5), (40, 35, 25), (5.1, 2.8)),
    Profile("Obesity", 10, Draw(25, 65, 44, 12), Draw(32, 50, 37, 5), Draw(110, 160, 128, 12),
            Draw(90, 160, 113, 18), Draw(180, 300, 233, 26), Draw(4, 7, 5.6, 1.0),
            (25, 45, 30), (70, 25, 4, 1), (50, 30, 20), (4.0, 2.6)),
    Profile("Prediabetes", 10, Draw(35, 70, 51, 10), Draw(26, 35, 29, 3.5), Draw(115, 145, 127, 10),
            Draw(100, 125, 111, 7), Draw(190, 250, 213, 18), Draw(5, 8, 6.6, 0.9),
            (30, 50, 20), (40, 35, 20, 5), (55, 25, 20), (3.2, 2.1)),
    Profile("Hyperlipidemia", 8, Draw(35, 75, 55, 12), Draw(23, 35, 27, 4), Draw(105, 150, 123, 12),
            Draw(80, 130, 98, 12), Draw(250, 350, 288, 28), Draw(5, 8, 6.9, 0.8),
            (35, 45, 20), (35, 40, 20, 5), (50, 30, 20), (4.3, 2.7)),
    Profile("MetabolicSyndrome", 6, Draw(40, 75, 59, 11), Draw(32, 45, 36, 4.5), Draw(140, 180, 153, 12),
            Draw(115, 180, 138, 20), Draw(220, 320, 258, 26), Draw(4, 7, 5.4, 0.9),
            (12, 38, 50), (60, 30, 8, 2), (35, 35, 30), (5.4, 3.1)),
    Profile("Anxiety", 5, Draw(20, 60, 37, 11), Draw(18, 32, 23, 4), Draw(100, 140, 116, 10),
            Draw(75, 110, 88, 10), Draw(150, 230, 183, 20), Draw(3, 6, 4.5, 1.0),
            (2, 18, 80), (30, 40, 25, 5), (50, 25, 25), (3.5, 2.5)),
    Profile("SleepDisorder", 3, Draw(25, 65, 45, 13), Draw(22, 38, 29, 5), Draw(105, 150, 125, 12),
            Draw(80, 130, 100, 14), Draw(160, 250, 200, 22), Draw(3, 5.5, 4.2, 0.8),
            (15, 40, 45), (50, 35, 12, 3), (50, 30, 20), (4.1, 2.5)),
    Profile("NutritionalDeficiency", 1, Draw(18, 70, 42, 15), Draw(15, 22, 19, 2), Draw(90, 120, 105, 8),
            Draw(70, 95, 82, 8), Draw(120, 180, 150, 15), Draw(5, 8, 6.5, 0.9),
            (40, 40, 20), (30, 40, 25, 5), (60, 25, 15), (2.0, 1.5)),
)

#: profile index for every percent 0..99
SLOTS = tuple(i for i, p in enumerate(PROFILES) for _ in range(p.weight))

DIET_TYPE_PERCENT = (40, 25, 20, 15)
