"""Weights, limits, vocabularies and labels of the risk model.

Everything in this module is a fixed value of the model: the texts and numbers
must stay as they are for results to agree with the published definitions.
Operators take them as defaults, so callers can pass their own.
"""

from dataclasses import dataclass

DEFAULT_PERIOD = "202604"
MIN_NEEDLE_CHARS = 4

# Texts that stand for "no value" once trimmed and lower-cased.
BLANK_WORDS = ("nan", "empty string", "")

# Vocabularies compared after lower-casing.
HIGH_RATINGS = ("alto", "médio", "medio")
NONCONFORM_RATINGS = ("alto", "médio", "medio", "baixo")
CLOUD_WORDS = ("true", "verdadeiro", "sim")
UP_TO_DATE = "up to date"
CRITICAL_FRAGMENT = "cr"
PRODUCTION_FRAGMENT = "produ"
OPERATIONAL_WORD = "operacional"

# Vocabularies compared as written (the job form of the server ranking).
HIGH_RATINGS_EXACT = ("Alto", "Médio", "Medio")
CRITICAL_IMPACTS_EXACT = ("Crítico", "Critico")
CLOUD_WORDS_UPPER = ("TRUE", "VERDADEIRO", "SIM")

# Classes and lights.
CLASS_HIGH, CLASS_MEDIUM, CLASS_LOW = "Alto", "Médio", "Baixo"
GREEN, YELLOW, RED = "Verde", "Amarelo", "Vermelho"
LIGHT_ORDER = (GREEN, YELLOW, RED)
LIGHT_CRITERION = "Verde <= 5%; Amarelo > 5% e < 20%; Vermelho >= 20%"
CONFORM, NONCONFORM = "Em conformidade", "Não esta em conformidade"

# Match tiers: (priority, label).
CATALOG_TIERS = {
    1: "MATCH_EXATO_NAME_VERSION",
    2: "MATCH_CONTEM_NAME_VERSION",
    3: "MATCH_CONTEM_NAME",
    99: "SEM_MATCH_CATALOGO",
}
RELATIONSHIP_TIERS = {
    1: "MATCH_CAT_PRODUTO_VERSION",
    2: "MATCH_CAT_PRODUTO",
    3: "MATCH_INST_PRODUTO_VERSION",
    4: "MATCH_INST_PRODUTO",
    5: "MATCH_CONTEM_PRODUTO_VERSION",
    6: "MATCH_CONTEM_PRODUTO",
    99: "SEM_MATCH_RELACIONAMENTO",
}
NO_MATCH = 99

# Constant columns.
KEY_KIND = "Servidor"
GOLD_LAYER = "gold"
NOT_INFORMED = "Não informado"
NOT_AVAILABLE = "N/A"
HUB_INDICATOR = "Obsolescência tecnológica por servidor"
HUB_CATCH_NAME = "Controle de softwares obsoletos por servidor"
HUB_HEADER_NAME = (
    "produto | versao | status | criticidade | indice_obsolescencia | rating | impacto | cloud | "
    "Nome | Pillar | Dominio | Subdominio | sigla_origem | ambiente | arquitetura"
)


@dataclass(frozen=True)
class SiglaWeights:
    high: float = 3.0
    critical: float = 2.0
    index: float = 2.0
    production: float = 0.2


@dataclass(frozen=True)
class ServerWeights:
    index: float = 10.0
    criticality: float = 10.0
    high: float = 2.0
    critical: float = 3.0


@dataclass(frozen=True)
class RemediationWeights:
    servers: float = 5.0
    high: float = 3.0
    critical: float = 4.0
    index: float = 10.0
    criticality: float = 10.0


@dataclass(frozen=True)
class ClassLimits:
    """Inclusive lower limits of the classes Alto and Médio."""

    high: float
    medium: float


SIGLA_LIMITS = ClassLimits(high=50.0, medium=20.0)
SERVER_LIMITS = ClassLimits(high=60.0, medium=20.0)


@dataclass(frozen=True)
class LightLimits:
    """Green up to and including ``green``; yellow below ``yellow``; red from there on."""

    green: float = 5.0
    yellow: float = 20.0
