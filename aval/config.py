"""Column names, fixed values and the tunable parameters of every stage."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: they must equal the data contract for results to be right. -------------

ID = "ID_Cliente"
AGE = "Edad"
INCOME = "Ingreso_Declarado"
SENIORITY = "Antiguedad_Laboral"
HOUSING = "Tipo_Vivienda"
AMOUNT = "Monto_Transaccion"
CURRENCY = "Moneda"
BALANCE = "Saldo_Promedio_Mensual"
FREQUENCY = "Frecuencia_Deposito"
SCORE = "Score_Buro"
CREDITS = "Creditos_Activos"
DELINQUENCY = "Mantiene_Morosidad_Previa"
TARGET = "credito_aprobado"

TOTAL_AMOUNT = "Monto_Total"
MAX_FREQUENCY = "Frecuencia_Deposito_Max"
N_TRANSACTIONS = "Num_Transacciones"

PROFILE_SOURCE = "perfil_solicitante"
HISTORY_SOURCE = "historial_transaccional"
BUREAU_SOURCE = "buro_credito"

PROFILE_COLUMNS = (ID, AGE, INCOME, SENIORITY, HOUSING)
HISTORY_COLUMNS = (ID, AMOUNT, CURRENCY, BALANCE, FREQUENCY)
BUREAU_COLUMNS = (ID, SCORE, CREDITS, DELINQUENCY)

SOURCE_COLUMNS = {
    BUREAU_SOURCE: BUREAU_COLUMNS,
    HISTORY_SOURCE: HISTORY_COLUMNS,
    PROFILE_SOURCE: PROFILE_COLUMNS,
}

RULE_COLUMNS = (ID, AGE, SCORE, DELINQUENCY, FREQUENCY)
RULE_FEATURES = (AGE, SCORE, DELINQUENCY, MAX_FREQUENCY)

#: Text values that a CSV cell may use for "missing" (the list pandas applies by default).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
YES_WORDS = ("si", "sí", "1", "true")
OWNED_HOUSING = "propia"
FOREIGN_CURRENCY = "USD"
HOME_CURRENCY = "MXN"
BUREAU_ID_PREFIX = "(?i)^cliente_"
HOME_ID_PREFIX = "CLI-"
MISSING_TEXT = "ND"
NEW_APPLICANT_ID = "NUEVO-%03d"

LOGISTIC = "Regresión logística"
FOREST = "Random forest"
METRICS = ("exactitud", "precision", "recall", "f1")

# --- Internal helper columns ---------------------------------------------------------------

SEQ = "_seq"
SPLIT = "split"
TRAIN, TEST = "train", "test"
FOLD = "fold"
SEGMENT = "segmento"
MODEL, PREDICTION, PROBABILITY = "modelo", "prediccion", "probabilidad"


@dataclass(frozen=True)
class CleaningConfig:
    """Bounds and rate used while cleaning the sources."""

    usd_rate: float = 15.0
    min_age: float = 18
    max_age: float = 70


@dataclass(frozen=True)
class ApprovalRule:
    """Thresholds of the business rule: both age bounds are inclusive, the score is strict."""

    min_age: float = 18
    max_age: float = 69
    score_above: float = 600


@dataclass(frozen=True)
class ChartThresholds:
    """Cut-offs that turn report numbers into flags."""

    imbalance: float = 0.40
    moderate_correlation: float = 0.30
    weak_correlation: float = 0.10
    strong_silhouette: float = 0.50
    moderate_silhouette: float = 0.25
    low_recall: float = 0.5
    tie: float = 1e-9


@dataclass(frozen=True)
class PreparationConfig:
    """Split and feature preparation.

    ``exact_median_rows`` is the largest non-missing count for which Spark's one-buffer exact
    ``median`` is used; above it the same exact value is found by narrowing a quantile bracket.
    ``max_categories`` stops a one-hot encoding that would not fit as columns, ``max_classes`` a
    label with that many values, which is no class.
    """

    test_size: float = 0.2
    seed: int = 42
    exact_median_rows: int = 1_000_000
    max_categories: int = 1_000
    max_classes: int = 1_000


@dataclass(frozen=True)
class TrainingConfig:
    """Hyper-parameters of the two classifiers and the segmentation.

    ``min_instances_per_node`` is the fewest training rows a leaf of the forest may have. With 1
    and a depth of 30 the number of nodes follows the rows, and all trees are kept in the driver
    and sent to every task: at 10⁹ rows set it so that rows / value stays near a few thousand.
    """

    seed: int = 42
    inverse_regularisation: float = 1.0
    max_iterations: int = 1000
    trees: int = 100
    tree_depth: int = 30
    tree_bins: int = 128
    min_instances_per_node: int = 1
    segments: int = 3
    segment_starts: int = 10
    segment_iterations: int = 300


@dataclass(frozen=True)
class EvaluationConfig:
    """Cross-validation and silhouette settings.

    ``silhouette_metric`` and ``silhouette_anchors`` hold at every number of rows: ``"euclidean"`` measures all
    rows against so many anchors per cluster, in linear time and with a standard error (exact where no
    cluster is larger), or against all rows without anchors; ``"squaredEuclidean"`` is another, also
    linear number, whose levels have no names. ``max_segments`` bounds the clusters a
    silhouette is measured over, of which it keeps one row each. ``prepare_folds`` learns
    imputation, categories and scaling anew from the training part of every fold. ``roc_tolerance``
    is the area by which the curve of the report may differ from the exact one; None gives that.
    """

    folds: int = 5
    seed: int = 42
    segment_counts: tuple[int, ...] = (2, 3, 4, 5)
    silhouette_block: int = 2_000
    silhouette_metric: str = "euclidean"
    silhouette_anchors: int | None = 1_000
    max_segments: int = 1_000
    parallel_fits: int = 8
    prepare_folds: bool = False
    roc_tolerance: float | None = 0.001


@dataclass(frozen=True)
class PipelineConfig:
    """Everything configurable, in one place."""

    cleaning: CleaningConfig = field(default_factory=CleaningConfig)
    rule: ApprovalRule = field(default_factory=ApprovalRule)
    preparation: PreparationConfig = field(default_factory=PreparationConfig)
    training: TrainingConfig = field(default_factory=TrainingConfig)
    evaluation: EvaluationConfig = field(default_factory=EvaluationConfig)
    charts: ChartThresholds = field(default_factory=ChartThresholds)
